"""Dates and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_dmy(c) -> Column:
    """``d/M/yyyy`` text (padding optional) to date; bad text to null."""
    return F.try_to_date(_c(c), "d/M/yyyy")


def parse_mdy_hm(c) -> Column:
    """``M/d/yyyy H:mm`` text to timestamp; a timestamp passes through."""
    c = _c(c)
    return F.coalesce(F.try_to_timestamp(c.cast("string"), F.lit("M/d/yyyy H:mm")),
                      F.try_to_timestamp(c.cast("string")))


def to_ts(c, fmt: str | None = None) -> Column:
    """Text to timestamp with a stated format (no guessing)."""
    if fmt is None:
        return F.try_to_timestamp(_c(c))
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def year_of(c) -> Column:
    """C06."""
    return F.year(_c(c))


def date_part(c) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_c(c))


def iso_date(c) -> Column:
    """``yyyy-MM-dd`` text (used at the sinks only)."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def year_range_filter(c, year: int) -> Column:
    """F04/F05 as a range on the raw timestamp, so it reaches the scan."""
    # literals from text, so no time zone is involved
    lo = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    col = _c(c)
    return (col >= lo) & (col < hi)


def month_end_flag(as_of) -> Column:
    """True when ``as_of`` is the last day of its month."""
    d = _c(as_of).cast("date")
    return F.last_day(d) == d


def period_yyyymm(as_of) -> Column:
    """``yyyyMM`` period text."""
    return F.date_format(_c(as_of), "yyyyMM")
