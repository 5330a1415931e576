"""Scans over segments against pandas and plain windows, with hot groups that
span several range partitions."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitwise.operators import intervals, scans

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, id long, v long"


def rows(n=400, seed=1):
    """Key 'hot' holds two thirds; null keys, null and equal times, null values."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None, "c"])
        ts = None if rng.random() < 0.03 else T0 + dt.timedelta(seconds=rng.randrange(n // 2))
        out.append((k, ts, i, None if rng.random() < 0.2 else rng.randrange(100)))
    return out


@pytest.fixture
def small(spark):
    """Many range partitions, as adaptive execution would not make of so few rows."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    for c, v in old.items():
        spark.conf.set(c, v)


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(a.columns).collect()))


KEYS, ORDER = ["k"], ["ts", "id"]


def segmented(spark, data):
    seg = scans.segments(spark.createDataFrame(data, SCHEMA), KEYS, ORDER)
    assert seg.where("k = 'hot'").select(scans.SEGMENT).distinct().count() > 3
    return seg


def test_running_totals_and_lasts(spark, small):
    data = rows()
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = spark.createDataFrame(data, SCHEMA).withColumns({"t": F.sum("v").over(w), "l": F.last("v", True).over(w)})
    seg = segmented(spark, data)
    same(scans.running_last(scans.running_totals(seg, KEYS, ORDER, {"t": "v"}), KEYS, ORDER, {"l": "v"}).drop(scans.SEGMENT), want)


@pytest.mark.parametrize("before, after", [(1, 0), (0, 1), (3, 2), (40, 0), (0, 70)])
def test_frames(spark, small, before, after):
    """Also frames longer than a segment."""
    data = rows()
    columns = {"s": lambda w: F.sum("v").over(w.rowsBetween(-before, after)),
               "g": lambda w: F.lag("id", before).over(w) if before else F.lead("id", after).over(w)}
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = spark.createDataFrame(data, SCHEMA).withColumns({n: f(w) for n, f in columns.items()})
    same(scans.framed(segmented(spark, data), KEYS, ORDER, before, after, columns).drop(scans.SEGMENT), want)


@pytest.mark.parametrize("tolerance", [None, 5])
def test_asof_join(spark, small, tolerance):
    left, right = rows(seed=2), rows(150, seed=3)
    right += [("hot", T0 + dt.timedelta(seconds=9), 900, 1), ("hot", T0 + dt.timedelta(seconds=9), 901, 2)]
    df_l = spark.createDataFrame(left, SCHEMA)
    df_r = spark.createDataFrame(right, SCHEMA).withColumnsRenamed({"ts": "at", "id": "rid", "v": "rv"})
    got = scans.asof_join(df_l, df_r, ["k"], "ts", "at", "rid", tolerance and dt.timedelta(seconds=tolerance), "id")
    want = []
    for k, ts, i, v in left:
        best = max([(at, rid, rv) for rk, at, rid, rv in right if rk is not None and rk == k and ts is not None
                    and at is not None and at <= ts], default=None, key=lambda r: r[:2])
        if best and tolerance and ts - best[0] > dt.timedelta(seconds=tolerance):
            best = None
        want.append((k, ts, i, v, *(best or (None,) * 3)))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    empty = scans.asof_join(df_l, df_r.where("false"), ["k"], "ts", "at", "rid")
    assert empty.where("rid is not null").count() == 0 and empty.count() == len(left)
    assert scans.asof_join(df_l.where("false"), df_r, ["k"], "ts", "at", "rid").count() == 0


def test_sessions(spark, small):
    data = rows(seed=4)
    got = scans.sessions(spark.createDataFrame(data, SCHEMA), ["k"], "ts", "id", 3, n=F.count(F.lit(1)), total=F.sum("v"))
    want = []
    for k in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == k and r[1] is not None), key=lambda r: r[1:3])
        group = []
        for r in mine:
            if group and (r[1] - group[-1][-1][1]).total_seconds() < 3:
                group[-1].append(r)
            else:
                group.append([r])
        for i, g in enumerate(group, 1):
            values = [r[3] for r in g if r[3] is not None]
            want.append((k, i, g[0][1], g[-1][1] + dt.timedelta(seconds=3), len(g), sum(values) if values else None))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_no_window_over_a_whole_group_and_no_python(spark, small):
    """Every window over rows is inside a segment; those along a group see one row a segment."""
    seg = segmented(spark, rows())
    out = scans.framed(scans.running_totals(seg, KEYS, ORDER, {"t": "v"}), KEYS, ORDER, 2, 1,
                       {"g": lambda w: F.lag("id").over(w)})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
    specs = re.findall(r"(\w+\([^()]*\)) windowspecdefinition\((.*?)specifiedwindowframe", plan)
    # all but the count of a group's segments run inside a segment, or along the segments
    assert len(specs) > 6
    assert {f for f, spec in specs if scans.SEGMENT not in spec} == {"count(1)"}, specs


def interval_rows(n=300, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None])
        start = T0 + dt.timedelta(seconds=rng.randrange(3000))
        end = start + dt.timedelta(seconds=rng.choice([0, 1, 5, 30, 30, 700, -4]))
        out.append((k, i, None if rng.random() < 0.03 else start, None if rng.random() < 0.03 else end))
    return out


@pytest.mark.parametrize("width", [None, 1, 7, 100_000])
def test_range_join_and_overlaps(spark, small, width):
    data, points = interval_rows(), rows(120, seed=6)
    iv = spark.createDataFrame(data, "k string, iid long, s timestamp_ntz, e timestamp_ntz")
    pt = spark.createDataFrame(points, SCHEMA)
    want = [(k, ts, i, v, iid, s, e) for k, ts, i, v in points for ik, iid, s, e in data
            if k is not None and k == ik and None not in (ts, s, e) and s <= ts < e]
    got = intervals.range_join(pt, iv, ["k"], "ts", "s", "e", width)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    hit = {r[2] for r in want}
    left = intervals.range_join(pt, iv, ["k"], "ts", "s", "e", width, how="left")
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(
        map(repr, want + [(*p, None, None, None) for p in points if p[2] not in hit]))
    real = [r for r in data if None not in r and r[2] < r[3]]
    pairs = {(a[1], b[1]) for a in real for b in real
             if a[0] == b[0] and (a[2], a[1]) < (b[2], b[1]) and b[2] < a[3]}
    got = intervals.overlapping_pairs(iv, ["k"], "s", "e", "iid", width).select("iid_1", "iid_2").collect()
    assert len(got) == len(pairs) and {tuple(r) for r in got} == pairs


def test_interval_joins_are_equi_joins_that_can_be_split(spark):
    """No nested loops; both sides bring a shuffle of their own, so a hot (key, bin) is split when it runs."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        iv = (spark.range(4000).repartition(8).select(
            F.lit("hot").alias("k"), F.col("id").alias("iid"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 20)).cast("timestamp_ntz").alias("s"))
            .withColumn("e", F.col("s") + F.make_dt_interval(secs=F.lit(1))))
        out = intervals.overlapping_pairs(iv, ["k"], "s", "e", "iid", 10).groupBy().count()
        assert out.collect()[0][0] == 20 * 200 * 199 // 2
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert re.search(r"skew(ed)?=true|SortMergeJoin\(skew", plan), plan[:3000]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_bins_follow_the_density(spark):
    """Where many intervals overlap, bins are shorter than the intervals, so that few pairs
    meet that do not overlap; where few do, they are as long as 99 of 100 intervals."""
    def visits(each):  # every interval 100 s long, ``each`` of them starting in a second
        start = (F.lit(T0) + F.make_dt_interval(secs=F.floor(F.col("id") / each))).cast("timestamp_ntz")
        return spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("iid"), start.alias("s"),
                                        (start + F.make_dt_interval(secs=F.lit(100))).alias("e"))
    wide = intervals.balanced_width(visits(0.01), visits(0.01), ["k"], "s", "s", "e")
    tight = intervals.balanced_width(visits(20), visits(20), ["k"], "s", "s", "e")
    assert wide == 100 and 1 <= tight <= 20
    none = visits(1).where("false")
    assert intervals.balanced_width(none, none, ["k"], "s", "s", "e") == 1
    got = intervals.overlapping_pairs(visits(20), ["k"], "s", "e", "iid")
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()  # a shuffle deals the pairs
    seconds = 200
    assert got.count() == sum(20 * 19 // 2 + 400 * min(99, seconds - 1 - t) for t in range(seconds))


def test_overlaps_with_ties_and_null_ids(spark):
    """Of two that start together the one with the smaller id is the earlier, a null id before all; two null ids make no pair."""
    data = [(1, None, 0, 5), (1, None, 0, 5), (1, 2, 0, 5), (1, 1, 0, 9)]
    at = lambda c: (F.lit(T0) + F.make_dt_interval(secs=F.col(c))).cast("timestamp_ntz").alias(c)
    iv = spark.createDataFrame(data, "k int, iid int, s int, e int").select("k", "iid", at("s"), at("e"))
    got = intervals.overlapping_pairs(iv, ["k"], "s", "e", "iid").select("iid_1", "iid_2").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(["(None, 2)", "(None, 1)"] * 2 + ["(1, 2)"])
