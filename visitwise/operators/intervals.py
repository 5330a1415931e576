"""Range and interval joins on time bins.

A point lies in an interval of its key. Time is cut into bins; an interval is
copied to every bin that it touches, a point has one bin, so a pair meets in
exactly one place, by an equi-join on (key, bin): no nested loops, and no
duplicates to remove. A hot bin is split by adaptive execution, since both
sides come with a shuffle of their own.

The bin width decides how often intervals are copied, and how many pairs meet
that do not match. By default it is the length that 99 of 100 intervals do not
exceed, so those have two copies at most; where points and intervals stand so
dense that the pairs cost more than the copies, it is the width at which both
cost the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000
COPY_COST = 8  # pairs that meet in the time that one copy of an interval takes to shuffle and sort
_EPOCH = "1970-01-01 00:00:00"


def _micros(time):
    """Microseconds of a zone-less timestamp, whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), time)


def usual_length(intervals: DataFrame, start: str, end: str) -> int:
    """Seconds that 99 of 100 intervals do not exceed (at least 1)."""
    us = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
    got = intervals.where(us > 0).agg(F.percentile_approx(us, 0.99)).first()[0]
    return max(1, -(-(got or 0) // MICROS))


def balanced_width(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str) -> int:
    """Seconds of a bin (at least 1, at most :func:`usual_length`), from the rows as they are.

    Bins of w make (sum of lengths) / w copies of the intervals and, beyond the
    matches, w * (intervals * points within a short time, summed) pairs. Copies
    times their cost equal those pairs at the width returned. Starts and points
    are counted by key and bins of the usual length, so that bursts and hot
    keys weigh as they will in the join."""
    usual = usual_length(intervals, start, end)
    width = usual * MICROS

    def counts(df: DataFrame, time: str, *more) -> DataFrame:
        return (df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.floor(_micros(F.col(time)) / width).alias("_bin"))
                .agg(*more))

    real = intervals.where(F.col(start) < F.col(end))
    us = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)).cast("double")
    i = counts(real, start, F.count(F.lit(1)).cast("double").alias("_i"), F.sum(us).alias("_us"))
    p = counts(points, point, F.count(F.lit(1)).cast("double").alias("_p"))
    on = [f"_k{n}" for n in range(len(keys))] + ["_bin"]
    total, meet = i.join(p, on, "left").agg(F.sum("_us"), F.sum(F.col("_i") * F.col("_p"))).first()
    if not meet:
        return usual
    return max(1, min(usual, int((COPY_COST * total * width / meet) ** 0.5) // MICROS))


def range_join(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str,
               bin_seconds: int | None = None, point_prefix: str = "", interval_prefix: str = "",
               how: str = "inner") -> DataFrame:
    """Each point with every interval of its keys that holds it (``start`` <=
    point < ``end``): keys, the other columns of the points, then those of the
    intervals. ``how``: ``inner`` or ``left`` (points in no interval stay).
    Null keys, times and empty intervals match nothing."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    width = (bin_seconds or balanced_width(points, intervals, keys, point, start, end)) * MICROS
    p_cols, i_cols = ([c for c in df.columns if c not in keys] for df in (points, intervals))

    def dealt(df: DataFrame, cols: list[str], bins) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"),
                         bins.alias("_bin"))

    def bin_of(time) -> object:
        return F.floor(_micros(time) / width)

    a = dealt(points, p_cols, bin_of(F.col(point))).withColumnRenamed("_row", "_p")
    last = _micros(F.col(end)) - 1
    b = dealt(intervals.where(F.col(start) < F.col(end)), i_cols,
              F.explode(F.sequence(bin_of(F.col(start)), F.floor(last / width)))).withColumnRenamed("_row", "_i")
    on = [f"_k{i}" for i in range(len(keys))] + ["_bin"]
    at, lo, hi = F.col(f"_p.`{point}`"), F.col(f"_i.`{start}`"), F.col(f"_i.`{end}`")
    cond = F.expr(" AND ".join(f"a.{c} = b.{c}" for c in on)) & (lo <= at) & (at < hi)
    # by merge: the planner sees none of the copies and pairs, and would leave a
    # broadcast join of few bytes to the few tasks that scan the points
    out = a.alias("a").join(b.alias("b").hint("merge"), cond, how)
    return out.select(*[F.col(f"a._k{i}").alias(k) for i, k in enumerate(keys)],
                      *[F.col(f"_p.`{c}`").alias(f"{point_prefix}{c}") for c in p_cols],
                      *[F.col(f"_i.`{c}`").alias(f"{interval_prefix}{c}") for c in i_cols])


def overlapping_pairs(intervals: DataFrame, keys: list[str], start: str, end: str, row_id: str,
                      bin_seconds: int | None = None) -> DataFrame:
    """Pairs of intervals of one key that overlap, each once: the columns of
    the earlier one (by start, then ``row_id``) with ``_1``, of the later one
    with ``_2``. A pair is found where the later one starts. Intervals are
    half-open; empty and open-ended ones overlap nothing."""
    real = intervals.where(F.col(start) < F.col(end))
    cols = [c for c in intervals.columns if c not in keys]
    found = range_join(real, real, keys, start, start, end, bin_seconds, point_prefix="_later_", interval_prefix="_earlier_")
    # (start, row id) of the earlier one below that of the later one, null ids first:
    # column by column, since two structs would be built and compared for every pair
    (s1, s2), (r1, r2) = ([F.col(f"`_{side}_{c}`") for side in ("earlier", "later")] for c in (start, row_id))
    before = (s1 < s2) | ((s1 == s2) & ((r1.isNull() & r2.isNotNull()) | F.coalesce(r1 < r2, F.lit(False))))
    return found.where(before).select(*keys, *[F.col(f"`_earlier_{c}`").alias(f"{c}_1") for c in cols],
                                      *[F.col(f"`_later_{c}`").alias(f"{c}_2") for c in cols])
