"""Sinks: the Latin-1 ';' CSV golden of FIXTURES.md (S11) and the
balanced three-part export with the month-end period (Q10, S13, S14)."""

import datetime as dt
import glob
import os
import tempfile

from pyspark.sql import functions as F

from visitwise.operators.ranking import order_col
from visitwise.sources.sinks import compat_columns, export_unified, latin1_frame, write_csv


def _read_parts(path):
    data = b""
    for f in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        with open(f, "rb") as fh:
            data += fh.read()
    return data


def test_s11_latin1_csv_golden(spark):
    rows = [("", 900, 1, "añ漢"), ("x", None, None, None), ("", 86400, 2, "q;r")]
    df = spark.createDataFrame(rows, "a string, TimeDifference long, Flag_Time int, i string")
    out = compat_columns(latin1_frame(df)).toDF("a", "d", "r", "i").coalesce(1)
    path = os.path.join(tempfile.mkdtemp(prefix="vw-csv-"), "out")
    write_csv(out, path, sep=";", encoding="ISO-8859-1")
    got = _read_parts(path)
    assert got == (b"a;d;r;i\n;0 days 00:15:00;1.0;a\xf1\nx;;;\n"
                   b";1 days 00:00:00;2.0;\"q;r\"\n")


def test_export_three_parts_and_month_end(spark):
    df = spark.range(7).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    base = tempfile.mkdtemp(prefix="vw-export-")
    out, by_month = os.path.join(base, "result"), os.path.join(base, "by_month")
    parts = export_unified(df, [order_col("g"), order_col("k")], out, 3,
                           as_of=dt.date(2023, 1, 31), by_month_path=by_month)
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sizes == {1: 3, 2: 2, 3: 2}
    written = spark.read.option("header", True).option("sep", ";").csv(out)
    assert written.count() == 7
    assert sorted(r["part"] for r in written.select("part").distinct().collect()) == [1, 2, 3]
    assert os.path.isdir(os.path.join(by_month, "period=202301"))
    # not a month end: no period partition
    out2, bm2 = os.path.join(base, "r2"), os.path.join(base, "m2")
    export_unified(df, [order_col("k")], out2, 3, as_of=dt.date(2023, 1, 30), by_month_path=bm2)
    assert not os.path.exists(bm2)


def test_s12_strict_latin1_fails(spark):
    import pytest
    from visitwise.sources.sinks import check_latin1
    ok = spark.createDataFrame([("año",)], "t string")
    assert check_latin1(ok).count() == 1
    bad = spark.createDataFrame([("漢",)], "t string")
    with pytest.raises(Exception):
        check_latin1(bad).collect()


def test_s16_payment_methods_and_literals(spark):
    from visitwise.sources.files import literal_table
    from visitwise.sources.jdbc import payment_methods
    t = literal_table(spark, [(2, "01", "Contado")], "F025_ID_CIA int, F025_ID string, F025_DESCRIPCION string")
    assert payment_methods(t).columns == ["CIA", "COD_MED_PAGO", "DES_MED_PAGO"]


def test_export_keeps_global_order_inside_parts(spark):
    df = spark.range(50).select(((F.col("id") * 37) % 50).alias("k"))
    out = os.path.join(tempfile.mkdtemp(prefix="vw-order-"), "r")
    export_unified(df.repartition(4), [order_col("k")], out, 3)
    seen = []
    for part in (1, 2, 3):
        for f in sorted(glob.glob(os.path.join(out, f"part={part}", "*.csv"))):
            with open(f) as fh:
                seen += [int(x) for x in fh.read().split("\n")[1:] if x]
    assert seen == list(range(50))


def test_a_failed_write_leaves_the_published_output(spark):
    import pytest
    from visitwise.sources.sinks import write_parquet
    base = tempfile.mkdtemp(prefix="vw-publish-")
    out = os.path.join(base, "table")
    write_parquet(spark.range(5), out)
    write_parquet(spark.range(7), out)
    assert spark.read.parquet(out).count() == 7
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_parquet(bad, out)
    assert spark.read.parquet(out).count() == 7
    assert os.listdir(base) == ["table"]
    with pytest.raises(Exception, match="no"):
        write_csv(bad, out)
    assert spark.read.parquet(out).count() == 7


def test_month_end_keeps_other_periods(spark):
    from visitwise.sources.sinks import add_partitions_csv
    path = os.path.join(tempfile.mkdtemp(prefix="vw-months-"), "by_month")
    for period, n in (("202301", 3), ("202302", 4), ("202301", 2)):
        add_partitions_csv(spark.range(n).withColumn("period", F.lit(period)), path, ";", ["period"], "UTF-8")
    rows = spark.read.option("header", True).option("sep", ";").csv(path).groupBy("period").count().collect()
    assert {str(r["period"]): r["count"] for r in rows} == {"202301": 2, "202302": 4}


def test_month_end_swaps_whole_periods(spark):
    import pytest
    from visitwise.sources.sinks import add_partitions_csv
    base = tempfile.mkdtemp(prefix="vw-months-")
    path = os.path.join(base, "by_month")

    def add(df):
        add_partitions_csv(df.withColumn("period", F.lit("202301")), path, ";", ["period", "part"], "UTF-8")

    add(spark.range(9).withColumn("part", F.col("id") % 3))
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        add(bad.withColumn("part", F.lit(0)))
    assert spark.read.option("header", True).option("sep", ";").csv(path).count() == 9
    add(spark.range(4).withColumn("part", F.lit(0)))
    # no part of the earlier split is left, and nothing stays beside the folder
    assert sorted(os.listdir(os.path.join(path, "period=202301"))) == ["part=0"]
    assert os.listdir(base) == ["by_month"]
