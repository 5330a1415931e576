"""The daily job end to end on landed inputs derived from the sf0.001 tables."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from visitwise.plans import driver as D
from visitwise.plans.daily import run_daily

SF = "/root/testdata/sf0.001"


def test_daily_job(spark):
    base = tempfile.mkdtemp(prefix="vw-daily-")
    paths = {k: os.path.join(base, k) for k in ("clients", "calendar", "visits", "out", "by_month")}
    D.clients_raw(spark, SF).write.parquet(paths["clients"])
    D.visits_raw(spark, SF).write.parquet(paths["visits"])
    wide = D.calendar_wide(spark, SF)
    # the calendar lands as text, dates as d/M/yyyy, as in the calendar file
    wide.withColumn("FECHA", F.date_format("FECHA", "d/M/yyyy")).write.parquet(paths["calendar"])
    parts = run_daily(spark, paths["clients"], paths["calendar"], paths["visits"], paths["out"],
                      paths["by_month"], as_of=dt.date(2024, 1, 31))
    n = parts.count()
    sizes = sorted(r["count"] for r in parts.groupBy("part").count().collect())
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    written = spark.read.option("header", True).option("sep", ";").csv(paths["out"])
    assert written.count() == n
    # the header is the reference's (``Latitud`` next to ``LATITUD``)
    import glob
    first = sorted(glob.glob(os.path.join(paths["out"], "part=1", "*.csv")))[0]
    with open(first, encoding="latin-1") as fh:
        header = fh.readline().rstrip("\n").split(";")
    assert header[17:22] == ["LATITUD", "FECHAS_VISITA", "Logintud", "Latitud", "Inicio_Visita"]
    assert "Flag_Time" in header
    assert os.path.isdir(os.path.join(paths["by_month"], "period=202401"))
