"""Fill-in-middle transformation of texts.

A text is a run of units (white space and the word after it; at the end, white space
alone). One full match of ``(unit)*`` keeps every repetition of its group, so the ends
of that group give the number of units and both cuts, and nothing is stepped through.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.llm.common import arrow_columns, free_name

#: The group of a unit is atomic: what it matched is never tried again, so a match holds no way back.
UNITS = regex.compile(r"(?>([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+))*")
#: Characters matched at a time at least. Longer texts are matched in parts that end where a unit ends.
PART = 1 << 20
_UNIT_END = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")


@dataclass(frozen=True)
class Settings:
    """``rate`` per cent of the texts are cut, ``spm`` per cent of these begin with the suffix."""

    seed: int = 42
    rate: int = 50
    spm: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    def __post_init__(self):
        if not all(self.marks) or any(a != b and a in b for a, b in itertools.permutations(self.marks, 2)):
            raise ValueError("marks must not be empty, nor parts of each other")
        if len(set(self.marks)) < 3 or any(_may_overlap(a, b) for a in self.marks for b in self.marks):
            raise ValueError("marks must differ, and no end of one may begin another")


def _may_overlap(a: str, b: str) -> bool:
    return any(a[-i:] == b[:i] for i in range(1, min(len(a), len(b))))


def unit_ends(text: str, part: int = PART) -> Sequence[int]:
    """Where each unit of ``text`` ends, in code points."""
    if len(text) <= part:
        return UNITS.fullmatch(text).ends(1)
    ends, start = [], 0
    while start < len(text):
        cut = _UNIT_END.search(text, start + part)
        stop = cut.start() if cut else len(text)
        ends += UNITS.fullmatch(text, start, stop).ends(1)
        start = stop
    return ends


def cut(text: str, draw: str, settings: Settings) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of a text; ``draw`` is a hexadecimal hash."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = (int(draw[i : i + 8], 16) for i in (0, 8, 16, 24))
    if n == 0 or h3 % 100 >= settings.rate or any(m in text for m in settings.marks):
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, last))
    before, within, after = text[:a], text[a:b], text[b:]
    if h4 % 100 < settings.spm:
        return n, "spm", a, b - a, f"{settings.suffix}{after}{settings.prefix}{before}{settings.middle}{within}"
    return n, "psm", a, b - a, f"{settings.prefix}{before}{settings.suffix}{after}{settings.middle}{within}"


def rebuild(output: str, form: str, settings: Settings) -> str:
    """The text that ``cut`` turned into ``output``."""
    if form == "plain":
        return output
    lead, second = (settings.suffix, settings.prefix) if form == "spm" else (settings.prefix, settings.suffix)
    one, _, rest = output[len(lead) :].partition(second)
    two, _, within = rest.partition(settings.middle)
    return two + within + one if form == "spm" else one + within + two


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings(),
              keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    The draws of a row are parts of the SHA-256 of ``seed:key``, so they depend on
    nothing else and repeated rows get the same output; a null key counts as empty. Null
    and empty texts, texts that hold a mark, and those above ``rate`` stay as they are
    (form ``plain``, no cuts). Texts of any length are cut whole. Columns of the input
    with one of these names are replaced, ``keep`` names those that stay.
    """
    draw = free_name(docs, "draw")
    named = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    drawn = docs.withColumn(draw, F.sha2(named.cast("binary"), 256))

    def make():
        def apply(texts: pa.Array, draws: pa.Array):
            rows = [cut(t.as_py() or "", d.as_py(), settings) for t, d in zip(texts, draws, strict=True)]
            n, form, before, within, output = zip(*rows, strict=True) if rows else [()] * 5
            return [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                    pa.array(within, pa.int64()), pa.array(output, pa.string())]

        return apply

    outputs = "n long, form string, prefix_chars long, middle_chars long, output string"
    return arrow_columns(drawn, [text, draw], outputs, make, docs.columns if keep is None else keep)


def restore(cuts: DataFrame, settings: Settings = Settings(), output: str = "output", form: str = "form",
            keep: list[str] | None = None) -> DataFrame:
    """``cuts`` with ``restored``, the exact text that ``transform`` was given, from output and form alone.

    A null text comes back empty; null output gives null. A column ``restored`` is replaced.
    """

    def make():
        def apply(outputs: pa.Array, forms: pa.Array):
            pairs = zip(outputs.to_pylist(), forms.to_pylist(), strict=True)
            return [pa.array([None if o is None else rebuild(o, f, settings) for o, f in pairs], pa.string())]

        return apply

    return arrow_columns(cuts, [output, form], "restored string", make, keep)
