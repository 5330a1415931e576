"""Visit calendar: load, generate, unpivot (U01, C04 and the rule of SURVEY 1.4).

The calendar file lists, per day, a day code and three frequency codes
(weekly, biweekly, monthly).  Its codes follow a rule, so a calendar for any
date range can be generated on the cluster instead of shipped as a file.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitwise.functions.dates import parse_dmy

# Fixed values of the calendar file (labels by code, in code order).
DAY_LABELS = ["Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado"]
WEEKLY_LABEL = "Semanal"
BIWEEKLY_LABELS = ["Quincena 1 y 3", "Quincena 2 y 4"]
MONTHLY_LABELS = ["Mensual Semana 1", "Mensual Semana 2", "Mensual Semana 3", "Mensual Semana 4"]
# Monday that starts week 0 of the four-week cycle.
CYCLE_ANCHOR = _dt.date(2022, 12, 26)

WIDE_COLUMNS = ["FECHA", "COD_DIA_VISITA", "DES_DIA_VISITA", "COD_SEMANAL", "SEMANAL",
                "COD_QUINCENAL", "QUINCENAL", "COD_MENSUAL", "MENSUAL"]
FREQUENCY_COLUMNS = ["COD_SEMANAL", "COD_QUINCENAL", "COD_MENSUAL"]

# Header of the calendar file -> clean names (the file has blanks and a
# trailing blank in its names).
FILE_HEADER = {"FECHA": "FECHA", "COD_DIA VISITA": "COD_DIA_VISITA",
               "DIA VISITA": "DES_DIA_VISITA", "COD SEMANAL": "COD_SEMANAL",
               "SEMANAL": "SEMANAL", "COD QUINCENAL": "COD_QUINCENAL",
               "QUINCENAL": "QUINCENAL", "COD MENSUAL": "COD_MENSUAL",
               "MENSUAL": "MENSUAL"}


def _label(code_idx: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), code_idx.cast("int"))


def codes_for(d: Column) -> dict[str, Column]:
    """The calendar's columns as a function of the date ``d``."""
    dow = F.dayofweek(d)                       # Sunday 1 .. Saturday 7
    w = F.pmod(F.floor(F.datediff(d, F.lit(CYCLE_ANCHOR)) / 7), F.lit(4)).cast("int")
    return {
        "FECHA": d,
        "COD_DIA_VISITA": F.lpad(dow.cast("string"), 3, "0"),
        "DES_DIA_VISITA": _label(dow, DAY_LABELS),
        "COD_SEMANAL": F.lit("001"),
        "SEMANAL": F.lit(WEEKLY_LABEL),
        "COD_QUINCENAL": F.when(w % 2 == 0, F.lit("002")).otherwise(F.lit("003")),
        "QUINCENAL": _label(w % 2 + 1, BIWEEKLY_LABELS),
        "COD_MENSUAL": F.lpad((w + 4).cast("string"), 3, "0"),
        "MENSUAL": _label(w + 1, MONTHLY_LABELS),
    }


def generate_calendar(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    """Wide calendar for ``start..end`` (inclusive), one row per day.

    Size is ``end - start + 1`` rows, known before anything runs.
    """
    n = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(n).select(*[c.alias(k) for k, c in codes_for(d).items()])


def calendar_for_years(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Wide calendar for every year listed in ``years`` (derived from data)."""
    y = F.col(year_col).cast("int")
    days = years.select(y.alias("_y")).distinct().select(
        F.explode(F.sequence(F.make_date(F.col("_y"), F.lit(1), F.lit(1)),
                             F.make_date(F.col("_y"), F.lit(12), F.lit(31)))).alias("_d"))
    return days.select(*[c.alias(k) for k, c in codes_for(F.col("_d")).items()])


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """S04 for the calendar file: every column as text, header renamed,
    ``FECHA`` parsed from ``d/M/yyyy`` (C04)."""
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(9)]))
           .option("enforceSchema", True).csv(path))
    header_names = list(FILE_HEADER.values())
    df = raw.toDF(*header_names)
    return df.withColumn("FECHA", parse_dmy("FECHA"))


def unpivot_calendar(wide: DataFrame, keep_type: bool = False) -> DataFrame:
    """U01 + renames: one row per (date, day code, frequency code)."""
    long = wide.unpivot(["FECHA", "COD_DIA_VISITA"], FREQUENCY_COLUMNS,
                        "TIPO_CODIGO", "COD_FRECUENCIA_VISITA")
    cols = [F.col("FECHA").alias("FECHAS_VISITA"), "COD_DIA_VISITA"]
    if keep_type:
        cols.append("TIPO_CODIGO")
    cols.append("COD_FRECUENCIA_VISITA")
    return long.select(*cols)
