"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used.

    The optimizer may copy a column's expression into a filter, where repeated
    parts are computed repeatedly. It also keeps long chains of alternatives
    out of the generated method, which would grow past what the JVM compiles.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
