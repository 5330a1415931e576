"""The skew-safe operators on a hot group: one group holds a third of the
rows and thousands of distinct values, so it must spread over several
range partitions, and the results must still equal single-window ranks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from visitwise.operators.ranking import balanced_buckets, order_col, rank_tables


def _hot_frame(spark, n=6000):
    # group "hot" gets a third of the rows, the rest spread over 500 groups
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 2003).cast("double").alias("v"))


def test_hot_group_spans_partitions_and_ranks_are_exact(spark):
    df = _hot_frame(spark)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    ref = (df.withColumn("rd", F.dense_rank().over(w)).withColumn("rm", F.rank().over(w))
           .select("g", "v", "rd", "rm").distinct())
    # with and without adaptive coalescing of the range partitions (without
    # it the hot group surely crosses partition boundaries)
    for coalesce in ("false", "true"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        try:
            dense, mini = rank_tables(df, ["g"], [("v", "rd", "dense", True), ("v", "rm", "min", True)])
            got = dense.join(mini, ["g", "v"])
            assert sorted(got.collect()) == sorted(ref.collect())
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    # the hot group's distinct values fall into several range partitions
    hist = df.groupBy("g", "v").count()
    parts = (hist.repartitionByRange(8, "g", F.col("v").desc())
             .withColumn("p", F.spark_partition_id())
             .where("g = 'hot'").select("p").distinct().count())
    assert parts >= 2


def test_exact_buckets_with_many_ties(spark):
    # ties in the order key are broken by the id: exact ntile sizes anyway
    df = _hot_frame(spark, 3001)
    b = balanced_buckets(df.withColumn("id", F.monotonically_increasing_id()),
                         [order_col("g"), order_col("v"), order_col("id")], 7, "b")
    sizes = sorted(r["count"] for r in b.groupBy("b").count().collect())
    assert sizes == [428] * 2 + [429] * 5


def _formatted(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def test_unified_plan_has_no_single_group_window(spark):
    """No window of the unified query sees raw rows of a client-day: each
    works on rows that carry the range partition id ``_pid`` (per-partition
    ranks, or the span table with at most one row per partition a group
    touches)."""
    from visitwise.plans import registry as R
    text = _formatted(R.QUERIES["q09_unified"](spark, "/root/testdata/sf0.001"))
    sections = text.split("\n\n")
    windows = [sec for sec in sections if sec.lstrip().startswith("(") and ") Window" in sec.splitlines()[0]]
    assert windows
    for sec in windows:
        inputs = [line for line in sec.splitlines() if line.startswith("Input")]
        assert inputs and "_pid" in inputs[0], sec


def test_hot_key_of_the_full_match_is_split(spark):
    """One key holds a third of the facts: its join is split at run time."""
    from visitwise.operators.matching import natural_full_outer
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
        facts = spark.range(0, 200_000, 1, 12).select(key.alias("k"), F.col("id").alias("v"))
        due = spark.range(6000).select(F.col("id").alias("k"))
        out = natural_full_outer(due, facts, ["k"])
        assert out.count() == 200_000 + 6000 - facts.select("k").distinct().count()
        out = natural_full_outer(due, facts, ["k"])
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
