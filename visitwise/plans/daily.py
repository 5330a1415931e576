"""The daily job end to end (what the reference's nightly transform does).

    python -m visitwise.plans.daily --clients C --calendar K --visits V \\
        --out OUT [--by-month OUT_BY_MONTH] [--as-of YYYY-MM-DD] [--year YYYY]

Inputs are the landed extracts: clients and visits as parquet (S02), the
calendar as the CSV file or a parquet copy of it.  ``--as-of`` replaces
the reference's clock (default: today); ``--year`` the year fixed in the
reference (default: the as-of year).  Output: ``OUT/part=1..3`` CSV parts
(S13, S11) and, at month end, ``OUT_BY_MONTH/period=yyyyMM/part=..`` (S14).
The overwrite of ``OUT`` is the publish step (S15).
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from visitwise.functions.dates import parse_dmy
from visitwise.operators.calendar import read_calendar_csv
from visitwise.plans.prepare import prepare_calendar, prepare_clients, prepare_visits
from visitwise.plans.unified import ROW_ID, result_order, unified
from visitwise.sources.sinks import export_unified


def load_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The calendar as the file (CSV, text columns) or its parquet copy."""
    if path.endswith(".csv"):
        return read_calendar_csv(spark, path)
    df = spark.read.parquet(path)
    names = {c.strip().replace(" ", "_").upper(): c for c in df.columns}
    out = df.select(*[df[f"`{src}`"].alias(dst) for dst, src in (
        ("FECHA", names["FECHA"]), ("COD_DIA_VISITA", names["COD_DIA_VISITA"]),
        ("COD_SEMANAL", names["COD_SEMANAL"]), ("COD_QUINCENAL", names["COD_QUINCENAL"]),
        ("COD_MENSUAL", names["COD_MENSUAL"]))])
    if dict(out.dtypes)["FECHA"] == "string":
        out = out.withColumn("FECHA", parse_dmy("FECHA"))
    return out


def run_daily(spark: SparkSession, clients_path: str, calendar_path: str, visits_path: str,
              out_path: str, by_month_path: str | None = None, as_of: _dt.date | None = None,
              year: int | None = None, n_parts: int = 3) -> DataFrame:
    """Q04-Q10: prepare, match, rank, flag, clean, split and write."""
    as_of = as_of or _dt.date.today()
    year = year or as_of.year
    clients = prepare_clients(spark.read.parquet(clients_path))
    calendar = prepare_calendar(load_calendar(spark, calendar_path))
    visits = prepare_visits(spark.read.parquet(visits_path), year)
    res = unified(clients, calendar, visits, keep_row_id=True)
    return export_unified(res, result_order(res, row_id=True), out_path, n_parts, as_of=as_of,
                          by_month_path=by_month_path, row_id=ROW_ID)


def main(argv=None) -> None:
    from visitwise.session import get_session
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--clients", required=True)
    p.add_argument("--calendar", required=True)
    p.add_argument("--visits", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--by-month")
    p.add_argument("--as-of", type=_dt.date.fromisoformat)
    p.add_argument("--year", type=int)
    p.add_argument("--parts", type=int, default=3)
    a = p.parse_args(argv)
    spark = get_session(app="visitwise-daily")
    run_daily(spark, a.clients, a.calendar, a.visits, a.out, a.by_month, a.as_of, a.year, a.parts)


if __name__ == "__main__":
    main()
