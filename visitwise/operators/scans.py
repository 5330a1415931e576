"""Scans along a group's order that never need the whole group in one task:
running totals and last values, frames of neighbouring rows (``lag``, ``lead``,
moving aggregates), as-of joins and sessions.

All work on segments: rows are range-partitioned by (keys, order) and tagged
with their partition, so a group that holds a third of all rows spreads over
many partitions. Windows run inside (partition, group). What a group's later
segments need from the earlier ones is handed over the partition borders:

* a running total or last value, as one row per border;
* for a frame of k rows, the k rows before (after) the border, as ghost rows
  that take part in the window and are dropped afterwards.

A partition has at most two groups that cross its borders (its first and its
last one), so what is handed over is at most two totals, or 2 k rows, a
partition, and may be broadcast.

``order`` are column names, ascending, nulls first. Rows that are equal in all
of them are in no defined order and stay in one segment: end it with an id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitwise.operators.ranking import materialize

_UNB = Window.unboundedPreceding
SEGMENT = "_segment"


def segments(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with its range partition in ``_segment``, written once to the
    checkpoint folder: every consumer sees the same segments."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *[F.col(o) for o in order])
    return materialize(ranged.withColumn(SEGMENT, F.spark_partition_id()))


def _inside(keys: list[str]):
    return Window.partitionBy(SEGMENT, *keys)


def _on(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.`{n}`").eqNullSafe(F.col(f"{b}.`{n}`")) for n in names])


def _crossing(seg: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """One row per segment of the groups that have several, with aggregates."""
    each = seg.groupBy(*keys, SEGMENT).agg(F.count(F.lit(1)).alias("_rows"), *[a.alias(n) for n, a in aggregates.items()])
    return each.withColumn("_several", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_several > 1").drop("_several")


def _handed(seg: DataFrame, carried: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``seg`` with the carried columns of its (segment, group), null where there are none."""
    # at most two rows a segment (module doc)
    small = F.broadcast(carried.select(*keys, SEGMENT, *columns)).alias("_b")
    return (seg.alias("_a").join(small, _on("_a", "_b", [*keys, SEGMENT]), "left")
            .select("_a.*", *[F.col(f"_b.`{c}`") for c in columns]))


def running_totals(seg: DataFrame, keys: list[str], order: list[str], totals: dict[str, str]) -> DataFrame:
    """New columns (name -> summed column): the group's sum up to and with the
    row; null before the first value, as SQL's running ``sum``. Exact for
    integers and decimals; of doubles the order of additions is not fixed."""
    w = _inside(keys).orderBy(*order).rowsBetween(_UNB, 0)
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(_UNB, -1)
    carried = _crossing(seg, keys, **{f"_t_{n}": F.sum(c) for n, c in totals.items()})
    carried = carried.select(*keys, SEGMENT, *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in totals])
    out = _handed(seg.withColumns({n: F.sum(c).over(w) for n, c in totals.items()}), carried, keys,
                  [f"_c_{n}" for n in totals])
    types = dict(out.dtypes)
    out = out.withColumns({n: F.coalesce(F.col(n) + F.col(f"_c_{n}"), F.col(n), F.col(f"_c_{n}")).cast(types[n]) for n in totals})
    return out.drop(*[f"_c_{n}" for n in totals])


def running_last(seg: DataFrame, keys: list[str], order: list[str], lasts: dict[str, str]) -> DataFrame:
    """New columns (name -> column): the group's latest non-null value up to and with the row."""
    w = _inside(keys).orderBy(*order).rowsBetween(_UNB, 0)
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(_UNB, -1)
    place = F.struct(*order)
    carried = _crossing(seg, keys, **{f"_t_{n}": F.max_by(c, F.when(F.col(c).isNotNull(), place)) for n, c in lasts.items()})
    carried = carried.select(*keys, SEGMENT, *[F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts])
    out = _handed(seg.withColumns({n: F.last(c, ignorenulls=True).over(w) for n, c in lasts.items()}), carried, keys,
                  [f"_c_{n}" for n in lasts])
    return (out.withColumns({n: F.coalesce(n, f"_c_{n}") for n in lasts}).drop(*[f"_c_{n}" for n in lasts]))


def _ghosts(seg: DataFrame, keys: list[str], order: list[str], k: int, forward: bool) -> DataFrame:
    """For every segment that a group enters from another one, the ``k`` rows
    of the group before it (after it, unless ``forward``), tagged as that
    segment's. Edges are the last (first) ``k`` rows of each segment, numbered
    along the group; a border needs those of its last ``k`` numbers."""
    ahead = [F.col(o).asc() for o in order] if forward else [F.col(o).desc() for o in order]
    back = [F.col(o).desc() for o in order] if forward else [F.col(o).asc() for o in order]
    step = F.col(SEGMENT).asc() if forward else F.col(SEGMENT).desc()
    spans = _crossing(seg, keys)
    borders = (spans.withColumn("_to", F.sum(F.least("_rows", F.lit(k))).over(
        Window.partitionBy(*keys).orderBy(step).rowsBetween(_UNB, -1))).where("_to > 0")
        .select(*keys, F.col(SEGMENT).alias("_target"), "_to",
                F.explode(F.sequence(F.floor(F.greatest(F.col("_to") - k, F.lit(0)) / k),
                                     F.floor((F.col("_to") - 1) / k))).alias("_block")))
    edges = (seg.alias("_a").join(F.broadcast(spans.select(*keys, SEGMENT)).alias("_b"), _on("_a", "_b", [*keys, SEGMENT]), "left_semi")
             .withColumn("_n", F.row_number().over(_inside(keys).orderBy(*back))).where(F.col("_n") <= k)
             .withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(step, *ahead)) - 1)
             .withColumn("_block", F.floor(F.col("_n") / k)))
    own = [c for c in seg.columns if c != SEGMENT]
    return (edges.alias("_e").join(borders.alias("_t"), _on("_e", "_t", [*keys, "_block"]) & (F.col("_n") < F.col("_to"))
                                   & (F.col("_n") >= F.col("_to") - k))
            .select(*[F.col(f"_e.`{c}`") for c in own], F.col("_target").alias(SEGMENT)))


def framed(seg: DataFrame, keys: list[str], order: list[str], before: int, after: int,
           columns: dict[str, Callable]) -> DataFrame:
    """New columns of window functions that look at most ``before`` rows back
    and ``after`` rows ahead. Each is a function of the ordered window spec
    (without a frame): ``lambda w: F.lag("ts").over(w)`` or
    ``lambda w: F.avg("value").over(w.rowsBetween(-2, 0))``."""
    rows = seg.withColumn("_ghost", F.lit(False))
    for k, forward in ((before, True), (after, False)):
        if k:
            rows = rows.unionByName(_ghosts(seg, keys, order, k, forward).withColumn("_ghost", F.lit(True)))
    w = _inside(keys).orderBy(*order)
    return rows.withColumns({n: f(w) for n, f in columns.items()}).where("not _ghost").drop("_ghost")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, right_tie: str,
              tolerance=None, left_tie: str | None = None, prefix: str = "") -> DataFrame:
    """Every row of ``left``, with the columns of the latest row of ``right``
    (``prefix`` before their names) that has the same keys and a time not after
    the left row's; of right rows of one time the one with the largest
    ``right_tie``. ``tolerance`` (a ``datetime.timedelta``) is how much older
    than the left row it may be at most. Left rows without a match, or with a
    null key or time, have nulls; right rows with a null key or time match nothing.

    One range partitioning of both tables together; of a group that crosses
    partitions only its last right row is handed on.
    """
    others = [c for c in right.columns if c not in keys]
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in [*keys, left_time]])
    cells = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    found = F.struct(*[F.col(f"`{c}`") for c in others])
    both = (left.where(~no_key).select(*keys, F.col(left_time).alias("_time"), F.lit(1).alias("_side"),
                                       *([F.col(left_tie).cast("long")] if left_tie else [F.monotonically_increasing_id()]),
                                       cells.alias("_left"))
            .toDF(*keys, "_time", "_side", "_tie", "_left"))
    known = right.dropna(subset=[*keys, right_time]).select(
        *keys, F.col(right_time).alias("_time"), F.lit(0).alias("_side"), F.col(right_tie).cast("long").alias("_tie"),
        found.alias("_right"))
    order = ["_time", "_side", "_tie"]
    seg = segments(both.unionByName(known, allowMissingColumns=True), keys, order)
    got = running_last(seg, keys, order, {"_last": "_right"}).where("_side = 1")
    near = F.lit(True)
    if tolerance is not None:
        us = F.timestamp_diff("MICROSECOND", F.col(f"_last.`{right_time}`"), F.col("_time"))
        near = us <= int(tolerance.total_seconds() * 1_000_000)
    names = [f"{prefix}{c}" for c in others]
    out = got.select(*[F.col(f"_left.`{c}`").alias(c) for c in left.columns],
                     *[F.when(near, F.col(f"_last.`{c}`")).alias(n) for c, n in zip(others, names)])
    return out.unionByName(left.where(no_key), allowMissingColumns=True)


def numbered_sessions(df: DataFrame, keys: list[str], time: str, tie: str, gap_seconds: int) -> DataFrame:
    """``df`` with ``session``, its group's number from 1: a row starts one if
    it lies ``gap_seconds`` or more after the group's row before it. Rows
    without a time are left out."""
    order = [time, tie]
    seg = framed(segments(df.where(F.col(time).isNotNull()), keys, order), keys, order, 1, 0,
                 {"_before": lambda w: F.lag(time).over(w)})
    apart = F.timestamp_diff("MICROSECOND", F.col("_before"), F.col(time)) >= gap_seconds * 1_000_000
    seg = materialize(seg.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).drop("_before"))
    return running_totals(seg, keys, order, {"session": "_new"}).drop("_new", SEGMENT)


def sessions(df: DataFrame, keys: list[str], time: str, tie: str, gap_seconds: int, **aggregates: Column) -> DataFrame:
    """One row per session: keys, ``session_start``, ``session_end`` (the last
    row's time and the gap, as ``session_window`` has it) and aggregates, whose
    partial states are built before any shuffle, so a session may be of any size."""
    rows = numbered_sessions(df, keys, time, tie, gap_seconds)
    return rows.groupBy(*keys, "session").agg(
        F.min(time).alias("session_start"), (F.max(time) + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        *[a.alias(n) for n, a in aggregates.items()])
