"""Multisets, snapshots, grouping sets and sketches."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from visitwise.operators import rollups, setops

SCHEMA = "k long, v string"


def bags(seed):
    rng = random.Random(seed)

    def bag(n):
        return [(rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None])) for _ in range(n)] + [(9, "hot")] * rng.randrange(200)
    return bag(60), bag(50)


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_multisets(spark, seed):
    a, b = bags(seed)
    x, y = Counter(a), Counter(b)
    left, right = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert counted(setops.intersect_all(left, right)) == x & y
    assert counted(setops.except_all(left, right)) == x - y
    assert counted(setops.union_max(left, right)) == x | y
    assert counted(setops.except_all(left, right.where("false"))) == x
    assert setops.intersect_all(left.where("false"), right).count() == 0
    assert counted(setops.except_all(left, right)) == counted(left.exceptAll(right))


def test_a_hot_row_is_one_row_a_task_in_the_shuffle(spark):
    hot = spark.range(100_000).select(F.lit(1).cast("long").alias("k"), F.lit("same").alias("v"))
    out = setops.intersect_all(hot, hot)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortMergeJoin" not in plan and "Python" not in plan
    assert out.count() == 100_000


@pytest.mark.parametrize("seed", [3, 4])
def test_snapshot_diff_leads_from_old_to_new(spark, seed):
    a, b = bags(seed)
    a, b = a + [(50, "gone"), (None, "n")], b + [(60, "new"), (60, "new")]
    old, new = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    diff = setops.snapshot_diff(old, new, ["k"])
    assert counted(setops.apply_changes(old, diff)) == Counter(b)
    x, y = Counter(a), Counter(b)
    ka, kb = {k for k, _ in a}, {k for k, _ in b}
    want = {}
    for row in x | y:
        n = y[row] - x[row]
        if n:
            both = row[0] in ka and row[0] in kb
            kind = ("update_after" if n > 0 else "update_before") if both else ("insert" if n > 0 else "delete")
            want[row] = (kind, abs(n))
    assert {(r["k"], r["v"]): (r["change"], r["copies"]) for r in diff.collect()} == want
    assert setops.snapshot_diff(old, old, ["k"]).count() == 0


def test_grouping_sets_tell_null_from_rolled_up(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", None]), rng.choice(["p", "q"]), rng.choice([1, 5, None])) for _ in range(100)]
    df = spark.createDataFrame(data, "x string, y string, m long")
    states = rollups.grain_states(df, ["x", "y"], ["m"])
    got = rollups.grouping_sets(states, ["x", "y"], rollups.cube_sets(["x", "y"]), ["m"])
    want = df.cube("x", "y").agg(F.grouping_id().cast("long").alias("grouping_id"), F.count(F.lit(1)).alias("n"),
                                 F.count("m").alias("n_m"), F.sum("m").alias("sum_m"), F.min("m").alias("min_m"),
                                 F.max("m").alias("max_m"), F.avg("m").alias("avg_m"))
    assert counted(got) == counted(want.select(got.columns))
    assert rollups.rollup_sets(["x", "y"]) == [["x", "y"], ["x"], []]
    plan = got._jdf.queryExecution().executedPlan().toString()  # the expansion reads the states, not the rows
    assert "Expand" in plan and plan.split("Initial Plan")[0].count("Scan ExistingRDD") == 1


def test_sketches_merge_within_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 40).alias("day"), (F.col("id") * 7919 % 9001).alias("who"),
                                     F.when(F.col("id") % 10 != 0, F.col("id") * 31 % 100_000).alias("v"))
    days = rollups.sketch_states(df, ["day"], "who", "v")
    assert dict(days.dtypes)["distinct_sketch"] == dict(days.dtypes)["value_sketch"] == "binary"
    got = rollups.merged_sketches(days.withColumn("half", F.col("day") % 2), ["half"], {"p10": 0.1, "p50": 0.5}).collect()
    assert len(got) == 2
    for r in got:
        mine = df.where(F.col("day") % 2 == r["half"])
        exact = mine.agg(F.countDistinct("who"), F.count("v"), *[F.count_if(F.col("v") <= r[q]) for q in ("p10", "p50")]).first()
        assert abs(r["distinct_estimate"] - exact[0]) <= rollups.DISTINCT_ERROR * exact[0]
        assert abs(exact[2] / exact[1] - 0.1) <= rollups.RANK_ERROR and abs(exact[3] / exact[1] - 0.5) <= rollups.RANK_ERROR
    none = rollups.merged_sketches(rollups.sketch_states(df.withColumn("v", F.lit(None).cast("long")).limit(10), ["day"], "who", "v"),
                                   ["day"], {"p50": 0.5})
    assert none.where("p50 is not null").count() == 0
