"""Catalogued tables: plans without shuffles, and publishing by partition."""

import os
import re

import pytest
from pyspark.sql import functions as F

from visitwise.operators import setops
from visitwise.sources import catalog

SCHEMA = "k long, p string, v long"


@pytest.fixture
def plain_joins(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_join_has_no_shuffle(spark, plain_joins):
    """The registered query on the driver's tables, in its executed plan."""
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data absent")
    df = E.queries()["t17_bucketed_join"](spark, sf)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert len(re.findall(r"SelectedBucketsCount: 16 out of 16", plan)) >= 2
    assert len(rows) == E.queries()["j02_visit_left"](spark, sf).count()


def test_buckets_are_one_file_each(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("p"), F.col("id").alias("v"))
    t = catalog.save_table(df, "vw_buckets", str(tmp_path / "t"), bucket_by=["k"], buckets=4)
    assert t.count() == 1000 and len([f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")]) == 4
    with pytest.raises(ValueError):
        catalog.save_table(df, "vw_buckets", str(tmp_path / "u"), buckets=4)
    spark.sql("DROP TABLE vw_buckets")


def test_changes_reach_only_their_partitions(spark, tmp_path):
    old = [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "c", 4), (4, "c", 4), (5, "it's", 5), (6, None, 6)]
    new = [(1, "a", 1), (2, "a", 9), (3, "b", 3), (4, "c", 4), (7, "d", 7), (6, None, 8)]
    folder = tmp_path / "t"
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    catalog.save_table(a, "vw_snap", str(folder), partition_by=["p"])
    before = {f: os.path.getmtime(os.path.join(r, f)) for r, _, fs in os.walk(folder / "p=b") for f in fs}
    touched = catalog.publish_changes("vw_snap", setops.snapshot_diff(a, b, ["k"]), "p")
    assert touched == ["a", "c", "d", "it's", None]
    rows = sorted(map(repr, (tuple(r) for r in spark.table("vw_snap").select("k", "p", "v").collect())))
    assert rows == sorted(map(repr, new))
    assert {f: os.path.getmtime(os.path.join(r, f)) for r, _, fs in os.walk(folder / "p=b") for f in fs} == before
    assert not any("it" in p for p in catalog.partitions_of(spark, "vw_snap"))
    assert catalog.publish_changes("vw_snap", setops.snapshot_diff(b, b, ["k"]), "p") == []
    spark.sql("DROP TABLE vw_snap")
