"""NOT IN, semi and anti joins by SQL's null rules; variants; the SQL surface."""

import pytest
from pyspark.sql import functions as F

from visitwise.operators import membership as m
from visitwise.operators import variants

DATA = [(1, "a"), (2, "b"), (None, "c"), (3, "d"), (3, "d")] + [(7, "hot")] * 50
REFS = {"plain": [3, 7, 7, 9], "nulls": [3, None], "empty": [], "only null": [None]}


@pytest.mark.parametrize("name", list(REFS))
def test_against_sql(spark, name):
    df = spark.createDataFrame(DATA, "k long, v string")
    ref = spark.createDataFrame([(r,) for r in REFS[name]], "r long")
    df.createOrReplaceTempView("vw_rows")
    ref.createOrReplaceTempView("vw_ref")

    def same(got, sql):
        assert sorted(map(repr, got.collect())) == sorted(map(repr, spark.sql(sql).collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan

    same(m.not_in(df, ref, "k", "r"), "SELECT * FROM vw_rows WHERE k NOT IN (SELECT r FROM vw_ref)")
    same(m.semi(df, ref, ["k"], ["r"]), "SELECT * FROM vw_rows WHERE EXISTS (SELECT 1 FROM vw_ref WHERE r = k)")
    same(m.anti(df, ref, ["k"], ["r"]), "SELECT * FROM vw_rows WHERE NOT EXISTS (SELECT 1 FROM vw_ref WHERE r = k)")
    same(m.semi(df, ref, ["k"], ["r"], null_safe=True), "SELECT * FROM vw_rows WHERE EXISTS (SELECT 1 FROM vw_ref WHERE r <=> k)")
    same(m.anti(df, ref, ["k"], ["r"], null_safe=True), "SELECT * FROM vw_rows WHERE NOT EXISTS (SELECT 1 FROM vw_ref WHERE r <=> k)")


def test_variants(spark):
    eav = spark.createDataFrame([(1, 901, "-74.5"), (1, 902, "12"), (1, 7, "é \"x\""), (1, 901, "-80"), (2, 902, "no number"),
                                 (2, None, "lost"), (3, 5, None)] + [(9, 901, "same")] * 40, "entity long, attr_id int, value string")
    v = variants.entity_variants(eav)
    assert dict(v.dtypes)["attributes"] == "variant"
    got = {r["entity"]: (r["lon"], r["n"], r["rest"]) for r in v.select(
        "entity", *variants.typed("attributes", {"lon": ("$.901", "string"), "n": ("$.902", "int")}),
        variants.undeclared("attributes", ["901", "902"]).alias("rest")).collect()}
    assert got == {1: ("-80", 12, {"7": "é \"x\""}), 2: (None, None, {}), 3: (None, None, {"5": None}), 9: ("same", None, {})}
    assert variants.variant_schema(v.where("entity = 1"), "attributes").startswith("OBJECT<")
    assert variants.entity_variants(eav.where("false")).count() == 0


def test_sql_functions(spark):
    from visitwise.plans.views import SQL_FUNCTIONS, create_views
    import __spark_entry__ as E  # noqa: F401
    from visitwise.plans import registry as R
    sf = "/root/testdata/sf0.001"
    create_views(R.clients(spark, sf), R.calendar(spark, sf), R.visits(spark, sf))
    row = spark.sql("SELECT visit_seconds(TIMESTAMP_NTZ'2024-01-01 10:00:00', TIMESTAMP_NTZ'2024-01-01 10:01:01.5') AS s, "
                    "period_of(DATE'2024-02-29') AS p, month_end(DATE'2024-02-29') AS m, month_end(DATE'2024-02-28') AS n").first()
    assert tuple(row) == (61, "202402", True, False) and len(SQL_FUNCTIONS) == 3
    assert spark.table("due_list").count() == R.QUERIES["j01_due_list"](spark, sf).count()
    assert spark.sql("SELECT count(*) FROM visits").select(F.col("count(1)")).first()[0] > 0
