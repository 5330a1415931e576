"""Visit length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text pandas prints for a missing length.
SENTINEL_LENGTH = "nanh:nan min"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_seconds(start, end) -> Column:
    """End - start in whole seconds (long); null if either is null.

    Kept as seconds instead of an interval so that CSV, parquet and the
    oracle agree.  Sub-second parts are dropped toward minus infinity, as a
    timedelta's ``days``/``seconds`` split does.
    """
    # wall-clock difference of zone-less timestamps, independent of the
    # session time zone (no daylight-saving hour appears or vanishes)
    us = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(us / F.lit(1_000_000)).cast("long")


def _day_seconds(secs) -> Column:
    # timedelta.seconds: the part within one day, always 0..86399
    return F.pmod(_c(secs), F.lit(86400))


def length_text(secs, compat: bool = False) -> Column:
    """``{h}h:{m} min`` of the within-day part (days vanish, negatives wrap).

    Missing length: null, or the pandas sentinel with ``compat=True`` (C12).
    """
    s = _day_seconds(secs)
    txt = F.format_string("%dh:%d min", F.floor(s / 3600), F.floor((s % 3600) / 60))
    missing = F.lit(SENTINEL_LENGTH) if compat else F.lit(None).cast("string")
    return F.when(_c(secs).isNull(), missing).otherwise(txt)


def time_code(secs) -> Column:
    """C11: hour and minute digits glued without padding, as a number.

    1h05 and 0h15 both give 15 - the reference's ranking key, kept as is.
    """
    s = _day_seconds(secs)
    h = F.floor(s / 3600).cast("long").cast("string")
    m = F.floor((s % 3600) / 60).cast("long").cast("string")
    return F.concat(h, m).cast("double")


def duration_minutes(secs) -> Column:
    """Corrected length in whole minutes (monotonic in time)."""
    return F.floor(_c(secs) / 60).cast("long")


def timedelta_text(secs) -> Column:
    """Compat text of a timedelta as pandas prints it: ``0 days 00:15:00``,
    ``-1 days +23:00:00``."""
    s = _c(secs)
    days = F.floor(s / 86400).cast("long")
    rem = s - days * 86400
    hms = F.format_string("%02d:%02d:%02d", F.floor(rem / 3600).cast("int"),
                          F.floor((rem % 3600) / 60).cast("int"), (rem % 60).cast("int"))
    return F.when(s.isNull(), F.lit(None)).otherwise(
        F.concat(days.cast("string"), F.lit(" days "),
                 F.when(days < 0, F.lit("+")).otherwise(F.lit("")), hms))
