"""Operators against plain pandas statements on small random tables
(SURVEY 5, layer 3), including hot groups that span partitions."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from visitwise.operators.calendar import generate_calendar, unpivot_calendar
from visitwise.operators.matching import mark_join, natural_full_outer
from visitwise.operators.nullsafe import merge
from visitwise.operators.ranking import (balanced_buckets, first_per_key, grouped_rank,
                                         head, order_col, rank_tables, tail)


def test_outer_merge_null_keys(spark):
    # FIXTURES: left keys a, null; right keys null, b -> a, b and one matched null row
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([(None, 3), ("b", 4)], "k string, y int")
    got = sorted(merge(left, right, ["k"], "outer").collect(), key=repr)
    assert sorted([tuple(r) for r in got], key=repr) == sorted(
        [("a", 1, None), (None, 2, 3), ("b", None, 4)], key=repr)


def _random_groups(seed, n=400, hot=0.4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < hot else rnd.choice(["a", "b", "c", None])
        v = rnd.choice([None, float(rnd.randint(0, 60)), float(rnd.randint(0, 5))])
        rows.append((g, rnd.choice([1, 2]), v, i))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranks_match_pandas(spark, seed):
    rows = _random_groups(seed)
    df = spark.createDataFrame(rows, "g string, d int, v double, id int")
    got = grouped_rank(df, ["g", "d"], "v", "r_dense", "dense")
    got = grouped_rank(got, ["g", "d"], "v", "r_min", "min").toPandas().set_index("id").sort_index()
    pdf = pd.DataFrame(rows, columns=["g", "d", "v", "id"]).set_index("id")
    gb = pdf.groupby(["g", "d"])["v"]
    exp_dense = gb.rank(method="dense", ascending=False)
    exp_min = gb.rank(method="min", ascending=False)
    for i in pdf.index:
        for col, exp in (("r_dense", exp_dense), ("r_min", exp_min)):
            e, g = exp.get(i), got.loc[i, col]
            if pd.isna(e):
                assert pd.isna(g), (i, col)
            else:
                assert int(e) == int(g), (i, col, e, g)


def test_stacked_ranks_equal_single(spark):
    rows = _random_groups(7, 300)
    df = spark.createDataFrame(rows, "g string, d int, v double, id int").withColumn("w", -F.col("v"))
    a, b = rank_tables(df, ["g", "d"], [("v", "rv", "dense", True), ("w", "rw", "min", False)])
    sa = rank_tables(df, ["g", "d"], [("v", "rv", "dense", True)])[0]
    assert sorted(a.collect()) == sorted(sa.collect())
    assert b.count() == a.count()


def _full_outer_pandas(due, facts, keys):
    m = pd.merge(due, facts, how="outer", on=keys)
    return sorted(map(lambda t: tuple(None if pd.isna(x) else x for x in t),
                      m[sorted(m.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("seed", [11, 12])
def test_natural_full_outer_matches_pandas(spark, seed):
    rnd = random.Random(seed)
    due = [(rnd.choice(["x", "y", None]), rnd.choice([1, 2, None])) for _ in range(30)]
    facts = [(rnd.choice(["x", "y", "z", None]), rnd.choice([1, 2, 3, None]), i) for i in range(40)]
    dd = spark.createDataFrame(due, "k string, d int")
    ff = spark.createDataFrame(facts, "k string, d int, f int")
    got = natural_full_outer(dd, ff, ["k", "d"]).toPandas()
    got = sorted(map(lambda t: tuple(None if pd.isna(x) else x for x in t),
                     got[sorted(got.columns)].itertuples(index=False)), key=repr)
    exp = _full_outer_pandas(pd.DataFrame(due, columns=["k", "d"]),
                             pd.DataFrame(facts, columns=["k", "d", "f"]), ["k", "d"])
    assert got == exp


def test_natural_full_outer_with_copy_counts(spark):
    # a dimension row standing for 2 identical copies multiplies like the copies
    due = spark.createDataFrame([(1, dt.date(2023, 1, 2), 2)], "c long, d date, m long")
    facts = spark.createDataFrame([(1, dt.date(2023, 1, 2), 2, "v1"), (1, dt.date(2023, 1, 3), 2, "v2")],
                                  "c long, d date, m long, f string")
    got = natural_full_outer(due.select("c", "d", "m"), facts, ["c", "d"],
                             due_mult="m", fact_mult="m")
    counts = {r["f"]: r["count"] for r in got.groupBy("f").count().collect()}
    assert counts == {"v1": 4, "v2": 2}


def test_mark_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, x int")
    ref = spark.createDataFrame([("a",), ("a",)], "k string")
    got = sorted(mark_join(df, ref, ["k"], "hit").select("x", "hit").collect())
    assert [tuple(r) for r in got] == [(1, True), (2, False), (3, True)]


def test_ntile_sizes(spark):
    df = spark.createDataFrame([(i,) for i in range(8)], "x int")
    got = balanced_buckets(df, [order_col("x")], 3, "part").groupBy("part").count().orderBy("part")
    assert [r["count"] for r in got.collect()] == [3, 3, 2]


@pytest.mark.parametrize("n,k", [(1000, 3), (997, 10), (5, 7)])
def test_buckets_equal_ntile(spark, n, k):
    df = spark.range(n).withColumn("x", (F.col("id") * 7919) % 1009)
    mine = balanced_buckets(df, [order_col("x"), order_col("id")], k, "b").select("id", "b")
    ref = spark.sql(f"SELECT id, ntile({k}) OVER (ORDER BY (id * 7919) % 1009, id) AS b FROM range({n})")
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_sort_nulls_last_head_tail(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r[0] for r in head(df, [order_col("v", False)], 3).collect()] == [2, 1, None]
    assert [r[0] for r in tail(df, [("v", False)], 1).collect()] == [None]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 5, "w")],
                               "k string, o int, p string")
    got = {r["k"]: r["p"] for r in first_per_key(df, ["k"], [("o", True)]).collect()}
    assert got == {"a": "y", "b": "w"}


def test_calendar_rule_counts(spark):
    wide = generate_calendar(spark, dt.date(2023, 1, 1), dt.date(2023, 12, 31))
    counts = {(c, r["v"]): r["count"] for c in ("COD_DIA_VISITA", "COD_SEMANAL", "COD_QUINCENAL",
                                                 "COD_MENSUAL")
              for r in wide.groupBy(F.col(c).alias("v")).count().collect()}
    assert counts[("COD_DIA_VISITA", "001")] == 53
    assert all(counts[("COD_DIA_VISITA", f"00{i}")] == 52 for i in range(2, 8))
    assert counts[("COD_SEMANAL", "001")] == 365
    assert counts[("COD_QUINCENAL", "002")] == 183 and counts[("COD_QUINCENAL", "003")] == 182
    assert counts[("COD_MENSUAL", "004")] == 92
    assert all(counts[("COD_MENSUAL", f"00{i}")] == 91 for i in range(5, 8))
    first = wide.orderBy("FECHA").limit(2).collect()
    assert [(r.COD_DIA_VISITA, r.COD_QUINCENAL, r.COD_MENSUAL) for r in first] == [
        ("001", "002", "004"), ("002", "003", "005")]
    assert unpivot_calendar(wide).count() == 1095


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_full_merge_matches_pandas(spark, seed):
    rnd = random.Random(seed)
    left = [(rnd.choice(["a", "b", "hot", None]), rnd.choice([1, 2]), i) for i in range(40)]
    right = [(rnd.choice(["b", "c", "hot", None]), rnd.choice([1, 2, 3]), 100 + i) for i in range(30)]
    lp = pd.DataFrame(left, columns=["k", "d", "x"])
    rp = pd.DataFrame(right, columns=["k", "d", "x"])
    exp = pd.merge(lp, rp, how="outer", on=["k", "d"])
    got = merge(spark.createDataFrame(left, "k string, d int, x int"),
                spark.createDataFrame(right, "k string, d int, x int"), ["k", "d"], "outer").toPandas()
    assert list(got.columns) == list(exp.columns)

    def norm(df):
        return sorted((tuple(None if pd.isna(v) else v for v in t) for t in df.itertuples(index=False)), key=repr)
    assert norm(got) == norm(exp)


def test_due_rows_are_not_grouped_after_the_calendar(spark):
    """A client's dates are made by a join with distinct calendar rows, so no hash table of
    all due rows of a task stands behind it; copies of clients and calendar rows still multiply."""
    from visitwise.plans import registry as R
    for name in ("j03_unified_full", "q11_compliance"):
        plan = R.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "first(" not in plan, name
    due = spark.createDataFrame([(1, None, 6), (1, "a", 2), (None, "b", 1)], "c int, d string, m long")
    facts = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (None, "b", 30)], "c int, d string, x int")
    same = [sorted(map(str, natural_full_outer(due, facts, ["c", "d"], "hit", due_mult="m", due_distinct=once).collect()))
            for once in (True, False)]
    assert same[0] == same[1] and len(same[0]) == 6 + 2 + 1 + 1
