"""Date parsing and formatting. No expression reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmill.functions.binding import once
from newsmill.functions.text import trim_unicode

# Layouts beside ISO 8601, tried in this order after the weekday is removed
# (the weekday is not checked: feeds get it wrong).
FEED_LAYOUTS = (
    "d MMM yyyy[ HH:mm[:ss]][ Z]",
    "d MMM yy[ HH:mm[:ss]][ Z]",
    "MMM d[,] yyyy[ HH:mm:ss]",
    "MMMM d[,] yyyy[ HH:mm:ss]",
    "yyyy/MM/dd[ HH:mm:ss]",
)

# Zone names of RFC 822, which do not follow daylight saving.
ZONE_OFFSETS = (
    ("UT|UTC|GMT|Z", "+0000"),
    ("EDT", "-0400"),
    ("EST|CDT", "-0500"),
    ("CST|MDT", "-0600"),
    ("MST|PDT", "-0700"),
    ("PST", "-0800"),
)


def _iso(trimmed: Column) -> Column:
    return F.try_to_timestamp(F.when(trimmed.rlike(r"\A\d{4}(?:\z|-)"), trimmed))


def parse_iso(text: Column) -> Column:
    """Timestamp of an ISO 8601 string, NULL when it is not one."""
    return once(trim_unicode(text), _iso)


def _feed_date(bare: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(bare, F.lit(layout)) for layout in FEED_LAYOUTS])


def _plain(trimmed: Column) -> Column:
    """The date without its weekday and with a numeric zone."""
    bare = F.regexp_replace(trimmed, r"(?i)\A(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    for names, offset in ZONE_OFFSETS:
        bare = F.regexp_replace(bare, rf"(?i) (?:{names})\z", f" {offset}")
    return bare


def parse_lenient(text: Column, fallback: Column) -> Column:
    """Timestamp of a feed date; missing or unreadable dates give ``fallback``."""

    def parse(trimmed: Column) -> Column:
        return F.coalesce(_iso(trimmed), once(_plain(trimmed), _feed_date))

    return F.coalesce(once(trim_unicode(text), parse), fallback)


def run_date(value: Column) -> Column:
    """Date of a run from ``YYYY-MM-DD`` or an ISO time."""
    return F.to_date(F.substring(value, 1, 10))


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def display_date(value: Column) -> Column:
    """``Apr 8, 2026``; text that is no date is shown as it is."""
    return F.coalesce(F.date_format(parse_iso(value), "MMM d, yyyy"), value)


def as_of_window(as_of: str, hours: float) -> tuple[Column, Column]:
    """Inclusive bounds of the look-back window that ends at ``as_of``."""
    end = F.lit(as_of).cast("timestamp")
    return end - F.make_dt_interval(secs=F.lit(hours * 3600).cast("decimal(18,6)")), end


def recent(column: Column, as_of: str, hours: float = 48) -> Column:
    """Predicate: not older than ``hours`` before ``as_of``; the bound counts."""
    start, _ = as_of_window(as_of, hours)
    return column >= start
