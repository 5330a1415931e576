"""Query registry: one Spark query and one oracle SQL per operator family.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over the driver's whole
tables; ``ORACLE[name]`` is DuckDB SQL over the same tables (registered as
views) giving the same rows and column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.plans import driver as D
from visitwise.plans.prepare import prepare_calendar, prepare_clients, prepare_visits
from visitwise.plans.route import due_list, visit_facts
from visitwise.plans.unified import unified

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ shared inputs

def clients(spark, sf):
    return prepare_clients(D.clients_raw(spark, sf, kept_only=True))


def visits(spark, sf, year=None):
    return prepare_visits(D.visits_raw(spark, sf), year)


def calendar(spark, sf):
    return prepare_calendar(D.calendar_wide(spark, sf))


def _round(df: DataFrame, col: str, nd: int = 3) -> DataFrame:
    return df.withColumn(col, F.round(col, nd))


# ---------------------------------------------------------------- pipelines

@register("j01_due_list", D.due_sql())
def j01_due_list(spark: SparkSession, sf: str) -> DataFrame:
    """Clients x calendar, left after R1."""
    cal = calendar(spark, sf)
    return due_list(clients(spark, sf), cal)


@register("j02_visit_left",
          f"SELECT {', '.join(D.FACT_COLUMNS_SQL[:-2])}, round(Distancia_Haversine, 3) AS Distancia_Haversine, Rango_Visita FROM ({D.facts_sql()}) f")
def j02_visit_left(spark: SparkSession, sf: str) -> DataFrame:
    """Visit facts with length, code, distance and class."""
    return _round(visit_facts(visits(spark, sf), clients(spark, sf)), "Distancia_Haversine")


@register("q09_unified", D.unified_sql())
def q09_unified(spark: SparkSession, sf: str) -> DataFrame:
    """Q09: the unified statistics table (33 columns + is_scheduled)."""
    cal = calendar(spark, sf)
    return _round(unified(clients(spark, sf), cal, visits(spark, sf)),
                  "Distancia_Haversine")


def facts(spark, sf):
    return visit_facts(visits(spark, sf), clients(spark, sf))


FACTS = f"({D.facts_sql()}) f"
NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _sql_num(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{NUM_RE}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


# ------------------------------------------------------- sources, projections

@register("p01_rename", D.VISITS_RAW_SQL)
def p01_rename(spark, sf):
    """Rename projection of the visit extract (10 named columns)."""
    return D.visits_raw(spark, sf)


@register("u01_unpivot_calendar", D.calendar_long_sql(D.calendar_wide_sql()))
def u01_unpivot_calendar(spark, sf):
    """Calendar of every year with visits, unpivoted to one row per
    (date, day code, code type, frequency code)."""
    from visitwise.operators.calendar import unpivot_calendar
    return unpivot_calendar(D.calendar_wide(spark, sf), keep_type=True)


@register("f01_in_list", f"SELECT * FROM ({D.CLIENTS_RAW_SQL}) c WHERE COD_CANAL IN ('OFF', 'ON')")
def f01_in_list(spark, sf):
    """channel in-list filter."""
    return D.clients_raw(spark, sf).where(F.col("COD_CANAL").isin("OFF", "ON"))


@register("f03_not_null", f"SELECT ID_TERCERO, Inicio_Visita, Finalizacion_Visita FROM ({D.VISITS_RAW_SQL}) v WHERE Finalizacion_Visita IS NOT NULL")
def f03_not_null(spark, sf):
    """not-null filter (finished visits)."""
    return (D.visits_raw(spark, sf).where(F.col("Finalizacion_Visita").isNotNull())
            .select("ID_TERCERO", "Inicio_Visita", "Finalizacion_Visita"))


@register("f04_year", D.visits_sql("year(Inicio_Visita) = (SELECT max(year(ts)) FROM events)"))
def f04_year(spark, sf):
    """Q06 with F04: visits of the latest year (one value, read first), as a
    range filter on the raw timestamp that reaches the scan."""
    latest = D.table(spark, sf, "events").agg(F.max(F.year("ts"))).first()[0]
    return visits(spark, sf, latest if latest is not None else 1)


_PREFIX_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"


def _sql_prefix_num(x):
    return f"COALESCE(TRY_CAST(regexp_extract({x}, '{_PREFIX_RE}', 0) AS DOUBLE), 0.0)"


@register("f07_nonzero_text",
          f"SELECT * FROM ({D.VISITS_RAW_SQL}) v WHERE Logintud IS NOT NULL AND Latitud IS NOT NULL "
          f"AND {_sql_prefix_num('Logintud')} <> 0 AND {_sql_prefix_num('Latitud')} <> 0")
def f07_nonzero_text(spark, sf):
    """``longitud != 0 AND latitud != 0`` on text coordinates with the
    numeric-prefix rule of the source database (``-74,12`` is -74, text
    without digits is 0, null is dropped); no ANSI cast error."""
    from visitwise.plans.extract import nonzero_coordinates
    return nonzero_coordinates(D.visits_raw(spark, sf), "Logintud", "Latitud")


# ------------------------------------------------------------ scalar families

@register("c01_coord_text",
          f"SELECT ID_TERCERO, substr(replace(LONGITUD, ',', '.'), 1, 8) AS lon_text, "
          f"substr(replace(LATITUD, ',', '.'), 1, 8) AS lat_text FROM ({D.CLIENTS_RAW_SQL}) c")
def c01_coord_text(spark, sf):
    from visitwise.functions import coord_text
    c = D.clients_raw(spark, sf)
    return c.select("ID_TERCERO", coord_text("LONGITUD").alias("lon_text"),
                    coord_text("LATITUD").alias("lat_text"))


@register("c02_try_number",
          f"SELECT ID_TERCERO, Inicio_Visita, {_sql_num('Logintud')} AS lon_raw_num, "
          f"{_sql_num('Latitud')} AS lat_raw_num, "
          f"{_sql_num(chr(40) + 'substr(replace(Logintud, chr(44), chr(46)), 1, 8)' + chr(41))} AS lon_num "
          f"FROM ({D.VISITS_RAW_SQL}) v")
def c02_try_number(spark, sf):
    """Text to number, bad text (comma decimals) to null."""
    from visitwise.functions import coord_text, to_number
    v = D.visits_raw(spark, sf)
    return v.select("ID_TERCERO", "Inicio_Visita",
                    to_number("Logintud").alias("lon_raw_num"),
                    to_number("Latitud").alias("lat_raw_num"),
                    to_number(coord_text("Logintud")).alias("lon_num"))


_DMY_SQL = ("CAST(day(ts) AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || "
            "CAST(year(ts) AS VARCHAR)")
_MDY_SQL = ("CAST(month(ts) AS VARCHAR) || '/' || CAST(day(ts) AS VARCHAR) || '/' || "
            "CAST(year(ts) AS VARCHAR) || ' ' || CAST(hour(ts) AS VARCHAR) || ':' || "
            "lpad(CAST(minute(ts) AS VARCHAR), 2, '0')")


@register("c04_parse_date",
          f"SELECT event_id, {_DMY_SQL} AS fecha_text, CAST(strptime({_DMY_SQL}, '%d/%m/%Y') AS DATE) AS fecha FROM events")
def c04_parse_date(spark, sf):
    """``d/M/yyyy`` (unpadded) text to date."""
    from visitwise.functions import parse_dmy
    e = D.table(spark, sf, "events")
    txt = F.concat_ws("/", F.dayofmonth("ts").cast("string"), F.month("ts").cast("string"),
                      F.year("ts").cast("string"))
    return e.select("event_id", txt.alias("fecha_text"), parse_dmy(txt).alias("fecha"))


@register("c05_parse_ts",
          f"SELECT event_id, {_MDY_SQL} AS inicio_text, strptime({_MDY_SQL}, '%m/%d/%Y %H:%M') AS inicio FROM events")
def c05_parse_ts(spark, sf):
    """``M/d/yyyy H:mm`` text to timestamp."""
    from visitwise.functions import parse_mdy_hm
    e = D.table(spark, sf, "events")
    txt = F.concat(F.month("ts").cast("string"), F.lit("/"), F.dayofmonth("ts").cast("string"),
                   F.lit("/"), F.year("ts").cast("string"), F.lit(" "),
                   F.hour("ts").cast("string"), F.lit(":"),
                   F.lpad(F.minute("ts").cast("string"), 2, "0"))
    return e.select("event_id", txt.alias("inicio_text"),
                    parse_mdy_hm(txt).cast("timestamp_ntz").alias("inicio"))


_SECS = "CAST(floor((epoch_us(Finalizacion_Visita) - epoch_us(Inicio_Visita)) / 1000000.0) AS BIGINT)"
_LENGTHS = (f"(SELECT *, {_SECS} AS TimeDifference, ((({_SECS}) % 86400) + 86400) % 86400 AS ds "
            f"FROM ({D.VISITS_RAW_SQL}) v0) v")


def _lengths(spark, sf):
    from visitwise.functions import duration_seconds
    return D.visits_raw(spark, sf).withColumn(
        "TimeDifference", duration_seconds("Inicio_Visita", "Finalizacion_Visita"))


@register("c10_length_text",
          "SELECT ID_TERCERO, Inicio_Visita, TimeDifference, CASE WHEN ds IS NULL THEN 'nanh:nan min' ELSE "
          "CAST(CAST(floor(ds / 3600) AS BIGINT) AS VARCHAR) || 'h:' || "
          f"CAST(CAST(floor((ds % 3600) / 60) AS BIGINT) AS VARCHAR) || ' min' END AS TimeDifferenceD FROM {_LENGTHS}")
def c10_length_text(spark, sf):
    """C09 + C10 + C12: every visit's length in seconds and as ``1h:5 min`` text."""
    from visitwise.functions import length_text
    return _lengths(spark, sf).select("ID_TERCERO", "Inicio_Visita", "TimeDifference",
                                      length_text("TimeDifference", compat=True).alias("TimeDifferenceD"))


@register("c11_time_code",
          "SELECT ID_TERCERO, Inicio_Visita, CAST(CAST(CAST(floor(ds / 3600) AS BIGINT) AS VARCHAR) || "
          "CAST(CAST(floor((ds % 3600) / 60) AS BIGINT) AS VARCHAR) AS DOUBLE) AS \"Time\", "
          f"CAST(floor(TimeDifference / 60) AS BIGINT) AS duration_minutes FROM {_LENGTHS}")
def c11_time_code(spark, sf):
    """C11: the glued hour-minute code and the corrected length in minutes."""
    from visitwise.functions import duration_minutes, time_code
    return _lengths(spark, sf).select("ID_TERCERO", "Inicio_Visita", time_code("TimeDifference").alias("Time"),
                                      duration_minutes("TimeDifference").alias("duration_minutes"))


@register("c13_haversine",
          f"SELECT ID_TERCERO, Inicio_Visita, round({D._hav('Logintud', 'Latitud_Visita', 'LONGITUD', 'LATITUD')}, 3) AS haversine_m FROM {FACTS}")
def c13_haversine(spark, sf):
    """Unguarded haversine distance (metres) visit to client."""
    from visitwise.functions import haversine_m
    return facts(spark, sf).select(
        "ID_TERCERO", "Inicio_Visita",
        F.round(haversine_m("Logintud", "Latitud_Visita", "LONGITUD", "LATITUD"), 3)
        .alias("haversine_m"))


@register("c14_zero_guard",
          f"SELECT ID_TERCERO, Inicio_Visita, Logintud, LATITUD, round(Distancia_Haversine, 3) AS Distancia_Haversine FROM {FACTS}")
def c14_zero_guard(spark, sf):
    """C14: 0 when a coordinate is 0, null when one is missing."""
    return _round(facts(spark, sf).select("ID_TERCERO", "Inicio_Visita", "Logintud", "LATITUD",
                                          "Distancia_Haversine"), "Distancia_Haversine")


@register("c15_range_class",
          f"SELECT ID_TERCERO, Inicio_Visita, Rango_Visita, CASE WHEN Distancia_Haversine <= 200 THEN 'Si' "
          f"WHEN Distancia_Haversine > 200 THEN 'Fuera del Rango' ELSE '' END AS Cumpl_Rutero FROM {FACTS}")
def c15_range_class(spark, sf):
    """C15 + C16: range classes with both label sets."""
    from visitwise.functions import range_class_si
    return facts(spark, sf).select("ID_TERCERO", "Inicio_Visita", "Rango_Visita",
                                   range_class_si("Distancia_Haversine").alias("Cumpl_Rutero"))


@register("c17_flag",
          f"SELECT ID_TERCERO, Inicio_Visita, CASE WHEN Finalizacion_Visita IS NULL THEN 0 ELSE 1 END AS Flag_Fin FROM ({D.VISITS_RAW_SQL}) v")
def c17_flag(spark, sf):
    """C17: not-null flag 0/1 (finished visit)."""
    from visitwise.functions import not_null_flag
    return D.visits_raw(spark, sf).select("ID_TERCERO", "Inicio_Visita",
                                          not_null_flag("Finalizacion_Visita").alias("Flag_Fin"))


@register("c18_equal_flag",
          f"SELECT ID_TERCERO, Inicio_Visita, CASE WHEN CAST(Inicio_Visita AS DATE) = CAST(Finalizacion_Visita AS DATE) THEN 1 ELSE 0 END AS Flag_Mismo_Dia FROM ({D.VISITS_RAW_SQL}) v")
def c18_equal_flag(spark, sf):
    """Equality flag 0/1, null compares false (visit ends on its start day)."""
    from visitwise.functions import equal_flag
    v = D.visits_raw(spark, sf)
    return v.select("ID_TERCERO", "Inicio_Visita",
                    equal_flag(F.to_date("Inicio_Visita"), F.to_date("Finalizacion_Visita"))
                    .alias("Flag_Mismo_Dia"))


_CLEAN_DOC_SQL = ("SELECT doc_id, regexp_replace(strip_accents(text), '[^a-zA-Z0-9\\s]', '', 'g') "
                  "AS clean_text FROM documents")


@register("c19_clean_text", _CLEAN_DOC_SQL)
@register("c19_clean_text_exact", _CLEAN_DOC_SQL)
def c19_clean_text(spark, sf):
    """C19 on whole documents (exact NFKD on the JVM; both names, one form)."""
    from visitwise.functions import clean_text
    return D.table(spark, sf, "documents").select("doc_id", clean_text("text").alias("clean_text"))


@register("c20_strip_marks", "SELECT doc_id, strip_accents(text) AS plain_text FROM documents")
def c20_strip_marks(spark, sf):
    """C20: combining marks removed, punctuation kept."""
    from visitwise.functions import strip_marks
    return D.table(spark, sf, "documents").select("doc_id", strip_marks("text").alias("plain_text"))


@register("c21_code",
          "SELECT c_custkey, '00' || CAST(c_nationkey AS VARCHAR) AS code_ref, "
          "lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS code FROM customer")
def c21_code(spark, sf):
    """``'00' + n`` (10 gives ``0010``) next to the canonical code."""
    from visitwise.functions import code_canonical, code_from_int
    c = D.table(spark, sf, "customer")
    return c.select("c_custkey", code_from_int("c_nationkey").alias("code_ref"),
                    code_canonical("c_nationkey").alias("code"))


def _string_cols_sql_fill(cols_types):
    return ", ".join(f"COALESCE({c}, '') AS {c}" if t == "string" else c for c, t in cols_types)


_CLIENT_TYPES = [("COD_CIA", "int"), ("ROWID_TERCERO", "bigint")] + [
    (c, "int" if c == "IND_ESTADO_ACTIVO_CLIENTE" else "string")
    for c in D.CLIENT_KEYS[2:]]


@register("c24_fill", f"SELECT {_string_cols_sql_fill(_CLIENT_TYPES)} FROM ({D.CLIENTS_RAW_SQL}) c")
def c24_fill(spark, sf):
    """Missing text filled with ``''`` (numbers untouched)."""
    from visitwise.functions import fill_blank
    return fill_blank(D.clients_raw(spark, sf), "")


@register("c26_concat",
          f"SELECT ID_TERCERO, NIT_TERCERO || '-' || COD_FRECUENCIA_VISITA AS nit_frecuencia FROM ({D.CLIENTS_RAW_SQL}) c")
def c26_concat(spark, sf):
    """SQL CONCAT - null when a part is null."""
    from visitwise.functions import concat_strict
    c = D.clients_raw(spark, sf)
    return c.select("ID_TERCERO",
                    concat_strict("NIT_TERCERO", "COD_FRECUENCIA_VISITA", sep="-").alias("nit_frecuencia"))


@register("c30_period",
          "SELECT DISTINCT CAST(ts AS DATE) AS as_of, last_day(CAST(ts AS DATE)) = CAST(ts AS DATE) AS is_month_end, "
          "strftime(CAST(ts AS DATE), '%Y%m') AS period, CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS next_day FROM events")
def c30_period(spark, sf):
    """Per visit date - last day of month?, ``yyyyMM`` period, next day."""
    from visitwise.functions import month_end_flag, period_yyyymm
    d = D.table(spark, sf, "events").select(F.to_date("ts").alias("as_of")).distinct()
    return d.select("as_of", month_end_flag("as_of").alias("is_month_end"),
                    period_yyyymm("as_of").alias("period"),
                    F.date_add("as_of", 1).alias("next_day"))


@register("a06_count", "SELECT count(*) AS n_rows, 10 AS n_cols FROM events")
def a06_count(spark, sf):
    """Row count and width of the visit extract."""
    from visitwise.operators.grouping import shape
    return shape(D.visits_raw(spark, sf))


# ------------------------------------------------------------------- joins

CL = f"({D.CLIENTS_SQL})"
CAL = f"({D.calendar_long_sql(D.calendar_wide_sql())})"
VIS = f"({D.visits_sql()})"


@register("j03_unified_full",
          f"SELECT {', '.join(D.CLIENT_KEYS)}, FECHAS_VISITA, Inicio_Visita, "
          f"round(Distancia_Haversine, 3) AS Distancia_Haversine, "
          f"(_d IS NOT NULL AND FECHAS_VISITA IS NOT NULL) AS is_scheduled FROM ({D.matched_sql()}) j")
def j03_unified_full(spark, sf):
    """Due list full-matched with visit facts on the 19 natural keys
    (narrow-key, skew-safe form, see ``plans.unified.match_due_visits``)."""
    from visitwise.plans.unified import match_due_visits
    cal = calendar(spark, sf)
    res = match_due_visits(clients(spark, sf), cal, visits(spark, sf))
    return res.select(*D.CLIENT_KEYS, "FECHAS_VISITA", "Inicio_Visita",
                      F.round("Distancia_Haversine", 3).alias("Distancia_Haversine"),
                      (F.col("_matched") & F.col("FECHAS_VISITA").isNotNull()).alias("is_scheduled"))


@register("j05_inner_calendar",
          f"SELECT c.ID_TERCERO, c.COD_DIA_VISITA, c.COD_FRECUENCIA_VISITA, k.FECHAS_VISITA FROM {CL} c "
          f"JOIN {CAL} k ON c.COD_DIA_VISITA = k.COD_DIA_VISITA AND c.COD_FRECUENCIA_VISITA = k.COD_FRECUENCIA_VISITA")
def j05_inner_calendar(spark, sf):
    """Distinct clients x calendar, inner on the two codes."""
    from visitwise.plans.compliance import distinct_clients, due_rows
    cal = calendar(spark, sf)
    return due_rows(distinct_clients(clients(spark, sf)), cal).select(
        "ID_TERCERO", "COD_DIA_VISITA", "COD_FRECUENCIA_VISITA", "FECHAS_VISITA")


@register("j07_fanout",
          f"SELECT d.ID_TERCERO, d.FECHAS_VISITA, v.Inicio_Visita FROM (SELECT c.ID_TERCERO, k.FECHAS_VISITA FROM {CL} c "
          f"JOIN {CAL} k ON c.COD_DIA_VISITA = k.COD_DIA_VISITA AND c.COD_FRECUENCIA_VISITA = k.COD_FRECUENCIA_VISITA) d "
          f"JOIN {VIS} v ON d.ID_TERCERO = v.ID_TERCERO AND d.FECHAS_VISITA = v.FECHAS_VISITA")
def j07_fanout(spark, sf):
    """Due rows x visits on (client, date), right side not deduplicated:
    repeated visits on a due day multiply."""
    from visitwise.plans.compliance import due_rows
    cal = calendar(spark, sf)
    due = due_rows(clients(spark, sf), cal).select("ID_TERCERO", "FECHAS_VISITA")
    v = visits(spark, sf).select("ID_TERCERO", "FECHAS_VISITA", "Inicio_Visita")
    return due.join(v, ["ID_TERCERO", "FECHAS_VISITA"], "inner")


@register("j10_lookup",
          f"SELECT v.*, c.COD_CANAL FROM ({D.VISITS_RAW_SQL}) v JOIN (SELECT ID_TERCERO, COD_CANAL FROM ({D.CLIENTS_RAW_SQL}) c0) c "
          f"ON v.ID_TERCERO = c.ID_TERCERO")
def j10_lookup(spark, sf):
    """Visits enriched with the client's channel (lookup join)."""
    lk = D.clients_raw(spark, sf).select("ID_TERCERO", "COD_CANAL")
    return D.visits_raw(spark, sf).join(lk, "ID_TERCERO", "inner").select(
        *D.visits_raw(spark, sf).columns, "COD_CANAL")


def _list_sql(src: str, keys: str, val: str, out: str) -> str:
    return (f"SELECT {keys}, count(*) AS n_{out}, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS {out} "
            f"FROM (SELECT DISTINCT {keys}, {val} AS v FROM {src} WHERE {val} IS NOT NULL) s GROUP BY {keys}")


_J13_SQL = (f"SELECT c.ID_TERCERO, c.COD_DIA_VISITA, c.COD_FRECUENCIA_VISITA, v.n_visit_dates, v.visit_dates, "
            f"p.n_due_dates, p.due_dates FROM (SELECT DISTINCT ID_TERCERO, COD_DIA_VISITA, COD_FRECUENCIA_VISITA FROM {CL} c0) c "
            f"JOIN ({_list_sql(VIS, 'ID_TERCERO', 'FECHAS_VISITA', 'visit_dates')}) v ON c.ID_TERCERO = v.ID_TERCERO "
            f"JOIN ({_list_sql(CAL, 'COD_DIA_VISITA, COD_FRECUENCIA_VISITA', 'FECHAS_VISITA', 'due_dates')}) p "
            f"ON c.COD_DIA_VISITA = p.COD_DIA_VISITA AND c.COD_FRECUENCIA_VISITA = p.COD_FRECUENCIA_VISITA")


@register("j13_array_join", _J13_SQL)
def j13_array_join(spark, sf):
    """Per client, visit-date list joined to the due-date list of its
    plan (lists are distinct dates, bounded by the calendar)."""
    from visitwise.plans.compliance import grouped_dates
    cal = calendar(spark, sf)
    return grouped_dates(clients(spark, sf), cal, visits(spark, sf)).drop("n_due_visit_dates")


_DIST_SQL = ("SELECT CAST(user_id AS VARCHAR) || '-001' AS ID_TERCERO, "
             "CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 SECOND ELSE ts END AS Inicio_Visita, "
             "CAST(event_id % 500 AS DOUBLE) AS distancia FROM events")


def _distances(spark, sf):
    e = D.table(spark, sf, "events")
    return e.select(F.concat(F.col("user_id").cast("string"), F.lit("-001")).alias("ID_TERCERO"),
                    F.when(F.col("event_id") % 3 == 0, F.col("ts") + F.expr("INTERVAL 1 SECOND"))
                    .otherwise(F.col("ts")).alias("Inicio_Visita"),
                    (F.col("event_id") % 500).cast("double").alias("distancia"))


@register("j16_full_outer",
          f"SELECT COALESCE(v.ID_TERCERO, d.ID_TERCERO) AS ID_TERCERO, COALESCE(v.Inicio_Visita, d.Inicio_Visita) AS Inicio_Visita, "
          f"v.FECHAS_VISITA, d.distancia FROM {VIS} v FULL OUTER JOIN ({_DIST_SQL}) d "
          f"ON v.ID_TERCERO IS NOT DISTINCT FROM d.ID_TERCERO AND v.Inicio_Visita IS NOT DISTINCT FROM d.Inicio_Visita")
def j16_full_outer(spark, sf):
    """Visits full outer a distance table on (client, visit start)."""
    from visitwise.operators.nullsafe import merge
    v = visits(spark, sf).select("ID_TERCERO", "Inicio_Visita", "FECHAS_VISITA")
    return merge(v, _distances(spark, sf), ["ID_TERCERO", "Inicio_Visita"], "full")


@register("j18_all_due_dates",
          f"SELECT v.ID_TERCERO, v.Inicio_Visita, k.FECHAS_VISITA AS FECHA_PROGRAMADA, EXISTS (SELECT 1 FROM {CAL} m "
          f"WHERE m.COD_DIA_VISITA = c.COD_DIA_VISITA AND m.COD_FRECUENCIA_VISITA = c.COD_FRECUENCIA_VISITA "
          f"AND m.FECHAS_VISITA = v.FECHAS_VISITA) AS Cumple, k.FECHAS_VISITA = v.FECHAS_VISITA AS es_su_fecha "
          f"FROM {VIS} v JOIN (SELECT DISTINCT ID_TERCERO, COD_DIA_VISITA, COD_FRECUENCIA_VISITA FROM {CL} c0) c ON v.ID_TERCERO = c.ID_TERCERO "
          f"JOIN {CAL} k ON c.COD_DIA_VISITA = k.COD_DIA_VISITA AND c.COD_FRECUENCIA_VISITA = k.COD_FRECUENCIA_VISITA")
def j18_all_due_dates(spark, sf):
    """Every visit against every due date of its plan, with the
    visit's own mark."""
    from visitwise.plans.compliance import all_due_dates
    cal = calendar(spark, sf)
    return all_due_dates(clients(spark, sf), cal, visits(spark, sf))


@register("j19_mark_join",
          f"SELECT v.ID_TERCERO, v.Inicio_Visita, v.FECHAS_VISITA, EXISTS (SELECT 1 FROM {CAL} k WHERE k.COD_DIA_VISITA = c.COD_DIA_VISITA "
          f"AND k.COD_FRECUENCIA_VISITA = c.COD_FRECUENCIA_VISITA AND k.FECHAS_VISITA = v.FECHAS_VISITA) AS Cumple "
          f"FROM {VIS} v JOIN {CL} c ON v.ID_TERCERO = c.ID_TERCERO")
def j19_mark_join(spark, sf):
    """Mark join - each client visit flagged if its date was due."""
    from visitwise.plans.compliance import mark_scheduled
    cal = calendar(spark, sf)
    v = visits(spark, sf).join(clients(spark, sf).select("ID_TERCERO", "COD_DIA_VISITA",
                                                         "COD_FRECUENCIA_VISITA"), "ID_TERCERO")
    return mark_scheduled(v, cal).select("ID_TERCERO", "Inicio_Visita", "FECHAS_VISITA", "Cumple")


@register("j20_inner_chain",
          "SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
          "JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey")
def j20_inner_chain(spark, sf):
    """Chain of many-to-one inner joins (fact x three dimensions)."""
    o, c = D.table(spark, sf, "orders"), D.table(spark, sf, "customer")
    n, r = D.table(spark, sf, "nation"), D.table(spark, sf, "region")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select("o_orderkey", "c_name", "n_name", "r_name"))


# ------------------------------------------------------ EAV and role joins

def _eav(spark, sf):
    """EAV rows from ``part``: brand under 881/901, size under 882/902,
    type under id 0 for every tenth part."""
    p = D.table(spark, sf, "part")
    k = F.col("p_partkey")
    rows = F.array(
        F.struct(F.when(k % 2 == 0, F.lit(881)).otherwise(F.lit(901)).alias("attr_id"),
                 F.col("p_brand").alias("value")),
        F.struct(F.when(k % 3 != 0, F.lit(882)).otherwise(F.lit(902)).alias("attr_id"),
                 F.col("p_size").cast("string").alias("value")),
        F.struct(F.when(k % 10 == 0, F.lit(0)).alias("attr_id"), F.col("p_type").alias("value")))
    return (p.select(k.alias("entity"), F.explode(rows).alias("r"))
            .select("entity", "r.attr_id", "r.value").where(F.col("attr_id").isNotNull()))


_EAV_SQL = ("(SELECT p_partkey AS entity, CASE WHEN p_partkey % 2 = 0 THEN 881 ELSE 901 END AS attr_id, p_brand AS value FROM part "
            "UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 882 ELSE 902 END, CAST(p_size AS VARCHAR) FROM part "
            "UNION ALL SELECT p_partkey, 0, p_type FROM part WHERE p_partkey % 10 = 0)")


@register("u02_eav_pivot",
          f"SELECT entity, max(CASE WHEN attr_id IN (881, 901) THEN value END) AS LONGITUD, "
          f"max(CASE WHEN attr_id IN (882, 902) THEN value END) AS LATITUD FROM {_EAV_SQL} e GROUP BY entity")
def u02_eav_pivot(spark, sf):
    """EAV to columns by conditional aggregation (one pass)."""
    from visitwise.operators.eav import eav_pivot
    return eav_pivot(_eav(spark, sf))


@register("j23_eav_self",
          f"SELECT lg.entity, lg.value AS LONGITUD, lt.value AS LATITUD FROM {_EAV_SQL} lg JOIN {_EAV_SQL} lt "
          f"ON lg.entity = lt.entity WHERE lg.attr_id IN (881, 901) AND lt.attr_id IN (882, 902)")
def j23_eav_self(spark, sf):
    """The same through an EAV self-join."""
    from visitwise.operators.eav import eav_self_join
    return eav_self_join(_eav(spark, sf))


@register("j22_case_key",
          f"SELECT e.entity, e.attr_id, e.value, a.attr_rowid FROM {_EAV_SQL} e JOIN "
          f"(SELECT DISTINCT attr_id AS attr_rowid FROM {_EAV_SQL} x) a "
          f"ON (CASE WHEN a.attr_rowid IN (881, 901) THEN a.attr_rowid ELSE 0 END) = e.attr_id")
def j22_case_key(spark, sf):
    """Equi-join on a CASE key (ids outside the list become 0)."""
    from visitwise.operators.eav import case_key_join
    e = _eav(spark, sf)
    attrs = e.select(F.col("attr_id").alias("attr_rowid")).distinct()
    return case_key_join(e, attrs)


def _criteria(spark, sf):
    """Client criteria rows (plan, criterion) and their descriptions."""
    from visitwise.operators.calendar import DAY_LABELS
    c = D.table(spark, sf, "customer")
    k = F.col("c_custkey")
    day = F.lpad((k % 7 + 1).cast("string"), 3, "0")
    fq = F.when(k % 8 != 0, F.lpad((k % 8).cast("string"), 3, "0"))
    rows = F.array(F.struct(F.lit("001").alias("plan"), day.alias("crit")),
                   F.struct(F.lit("002").alias("plan"), fq.alias("crit")),
                   F.struct(F.lit("CCD").alias("plan"), F.col("c_mktsegment").alias("crit")),
                   F.struct(F.lit("VEN").alias("plan"), F.col("c_nationkey").cast("string").alias("crit")))
    crit = (c.select(k.alias("custkey"), F.explode(rows).alias("r"))
            .select("custkey", "r.plan", "r.crit").where(F.col("crit").isNotNull()))
    n = D.table(spark, sf, "nation")
    code = F.col("crit")
    desc = (crit.select("plan", "crit").distinct()
            .withColumn("descr", F.when(F.col("plan") == "001",
                                        F.element_at(F.array(*[F.lit(x) for x in DAY_LABELS]), code.cast("int")))
                        .when(F.col("plan") == "002",
                              F.element_at(F.array(*[F.lit(x) for x in D.FREQ_LABELS]), code.cast("int")))
                        .when(F.col("plan") == "CCD", F.concat(F.lit("Canal "), code)))
            .where(F.col("plan") != "VEN")
            .unionByName(n.select(F.lit("VEN").alias("plan"), F.col("n_nationkey").cast("string").alias("crit"),
                                  F.col("n_name").alias("descr"))))
    return crit, desc


_CRIT_SQL = ("(SELECT c_custkey AS custkey, '001' AS plan, lpad(CAST(c_custkey % 7 + 1 AS VARCHAR), 3, '0') AS crit FROM customer "
             "UNION ALL SELECT c_custkey, '002', lpad(CAST(c_custkey % 8 AS VARCHAR), 3, '0') FROM customer WHERE c_custkey % 8 <> 0 "
             "UNION ALL SELECT c_custkey, 'CCD', c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL "
             "UNION ALL SELECT c_custkey, 'VEN', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey IS NOT NULL)")


def _desc_sql():
    from visitwise.operators.calendar import DAY_LABELS
    return (f"(SELECT DISTINCT plan, crit, CASE plan WHEN '001' THEN {D._case('crit', DAY_LABELS)} "
            f"WHEN '002' THEN {D._case('crit', D.FREQ_LABELS)} ELSE 'Canal ' || crit END AS descr "
            f"FROM {_CRIT_SQL} x WHERE plan <> 'VEN' "
            f"UNION ALL SELECT 'VEN', CAST(n_nationkey AS VARCHAR), n_name FROM nation)")


def _role_sql():
    parts, cols = [], []
    for alias, plan, code_col, desc_col in (("p1", "001", "COD_DIA_VISITA", "DES_DIA_VISITA"),
                                            ("p2", "002", "COD_FRECUENCIA_VISITA", "DES_FRECUENCIA_VISITA"),
                                            ("pc", "CCD", None, "COD_CANAL"),
                                            ("pv", "VEN", "COD_VENDEDOR", "DES_VENDEDOR")):
        parts.append(f"LEFT JOIN {_CRIT_SQL} t{alias} ON t{alias}.custkey = c.c_custkey AND t{alias}.plan = '{plan}' "
                     f"LEFT JOIN {_desc_sql()} m{alias} ON m{alias}.plan = t{alias}.plan AND m{alias}.crit = t{alias}.crit")
        if code_col:
            cols.append(f"m{alias}.crit AS {code_col}")
        cols.append(f"m{alias}.descr AS {desc_col}")
    return f"SELECT c.c_custkey, {', '.join(cols)} FROM customer c {' '.join(parts)}"


@register("j21_role_left", _role_sql())
def j21_role_left(spark, sf):
    """Classification criteria of four plans per client: criteria meet
    their descriptions once, are gathered per client and plan, and opened plan
    by plan, so every combination stays and codes keep their descriptions."""
    from visitwise.plans.extract import CRITERIA_PLANS, criteria_lists, with_criteria
    crit, desc = _criteria(spark, sf)
    rows = crit.join(desc, ["plan", "crit"], "left").select(
        F.col("custkey").alias("c_custkey"), "plan", F.when(F.col("descr").isNotNull(), F.col("crit")).alias("code"), "descr")
    c = D.table(spark, sf, "customer").select("c_custkey")
    out = with_criteria(c, criteria_lists(rows, ["c_custkey"]), ["c_custkey"])
    return out.select("c_custkey", *[x for pair in CRITERIA_PLANS.values() for x in pair if x])


def _extract_tables(spark, sf):
    """Visit-extract sources: VISITA from events, USUARIO from customer,
    SUCURSAL from supplier."""
    e = D.table(spark, sf, "events")
    visita = e.select(
        F.when(F.col("event_id") % 101 == 0, F.lit("0"))
         .otherwise(F.concat(F.lit("-74,"), F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0")))
         .alias("longitud"),
        F.concat(F.lit("4,"), F.lpad((F.col("event_id") % 9973).cast("string"), 4, "0")).alias("latitud"),
        F.col("ts").alias("fecha_inicio"),
        (F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60))).alias("fecha_final"),
        F.col("user_id").alias("tercero_id"), (F.col("event_id") % 100).alias("vendedor_id"),
        (F.col("event_id") % 7).alias("sucursal_id"))
    c = D.table(spark, sf, "customer")
    usuario = c.select(F.col("c_custkey").alias("usuario_id"), F.col("c_name").alias("nombre_completo"),
                       F.col("c_mktsegment").alias("primer_apellido"),
                       F.col("c_nationkey").cast("string").alias("segundo_apellido"),
                       F.col("c_custkey").cast("string").alias("numero_identificacion"))
    s = D.table(spark, sf, "supplier")
    sucursal = s.select(F.col("s_suppkey").alias("sucursal_id"),
                        F.lpad(F.col("s_suppkey").cast("string"), 3, "0").alias("numero_sucursal"))
    return visita, usuario, sucursal


_VISITA_SQL = ("(SELECT CASE WHEN event_id % 101 = 0 THEN '0' ELSE '-74,' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') END AS longitud, "
               "'4,' || lpad(CAST(event_id % 9973 AS VARCHAR), 4, '0') AS latitud, ts AS fecha_inicio, "
               "ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS fecha_final, user_id AS tercero_id, "
               "event_id % 100 AS vendedor_id, event_id % 7 AS sucursal_id FROM events)")
_USUARIO_SQL = ("(SELECT c_custkey AS usuario_id, c_name AS nombre_completo, c_mktsegment AS primer_apellido, "
                "CAST(c_nationkey AS VARCHAR) AS segundo_apellido, CAST(c_custkey AS VARCHAR) AS numero_identificacion FROM customer)")
_SUCURSAL_SQL = "(SELECT s_suppkey AS sucursal_id, lpad(CAST(s_suppkey AS VARCHAR), 3, '0') AS numero_sucursal FROM supplier)"


_J24_SQL = f"""
WITH person AS (
  SELECT usuario_id AS who, numero_identificacion AS number,
         nombre_completo || ' ' || primer_apellido || ' ' || segundo_apellido AS customer_name,
         primer_apellido || ' ' || nombre_completo || ' ' || segundo_apellido AS seller_name
  FROM {_USUARIO_SQL} u),
stop AS (
  SELECT * FROM {_VISITA_SQL} s
  WHERE {_sql_prefix_num('longitud')} <> 0 AND {_sql_prefix_num('latitud')} <> 0)
SELECT longitud AS Logintud, latitud AS Latitud, fecha_inicio AS Inicio_Visita, fecha_final AS Finalizacion_Visita,
       buyer.customer_name AS Razon_Social_Cliente, buyer.number || '-' || numero_sucursal AS ID_TERCERO,
       buyer.number AS Nit, numero_sucursal AS Codigo_Sucursal, seller.number AS Codigo_Vendedor,
       seller.seller_name AS Des_vendedor
FROM stop JOIN {_SUCURSAL_SQL} branch USING (sucursal_id)
     JOIN person buyer ON buyer.who = tercero_id JOIN person seller ON seller.who = vendedor_id"""


@register("j24_role_inner", _J24_SQL)
def j24_role_inner(spark, sf):
    """The visit extract - visit x user (as customer) x user (as
    salesperson) x branch, inner; F07 filter; C26 concatenations."""
    from visitwise.plans.extract import visit_extract
    return visit_extract(*_extract_tables(spark, sf))


# --------------------------------------------------------------- grouping



@register("a01_collect_list",
          f"SELECT ID_TERCERO, CAST(sum(n) AS BIGINT) AS n_visit_dates, string_agg(strftime(v, '%Y-%m-%d') || ':' || CAST(n AS VARCHAR), ',' ORDER BY v) AS visit_dates "
          f"FROM (SELECT ID_TERCERO, FECHAS_VISITA AS v, count(*) AS n FROM {VIS} x WHERE ID_TERCERO IS NOT NULL AND FECHAS_VISITA IS NOT NULL "
          f"GROUP BY ID_TERCERO, FECHAS_VISITA) s GROUP BY ID_TERCERO")
def a01_collect_list(spark, sf):
    """Visit dates per client, duplicates kept as counts (``date:n``),
    sorted - one entry per distinct date, so a busy client stays bounded."""
    from visitwise.operators.grouping import value_runs
    return value_runs(visits(spark, sf), ["ID_TERCERO"], "FECHAS_VISITA", "visit_dates",
                      lambda c: F.date_format(c, "yyyy-MM-dd")).select(
        "ID_TERCERO", "n_visit_dates", "visit_dates")


@register("a01_list_values",
          f"SELECT ID_TERCERO, count(*) AS n_fechas, string_agg(strftime(FECHAS_VISITA, '%Y-%m-%d'), ',' ORDER BY FECHAS_VISITA) AS fechas "
          f"FROM {VIS} v WHERE ID_TERCERO IS NOT NULL AND FECHAS_VISITA IS NOT NULL GROUP BY ID_TERCERO")
def a01_list_values(spark, sf):
    """The list of all visit dates per client, duplicates kept (an array;
    shown as text)."""
    from visitwise.operators.grouping import value_list
    lists = value_list(visits(spark, sf), ["ID_TERCERO"], "FECHAS_VISITA", "fechas")
    return lists.select("ID_TERCERO", F.size("fechas").cast("long").alias("n_fechas"), _dates_text("fechas").alias("fechas"))


@register("a02_distinct_list",
          f"SELECT a.ID_TERCERO, a.n_visit_dates, a.visit_dates, b.n_weekdays, b.weekdays FROM "
          f"({_list_sql(VIS, 'ID_TERCERO', 'FECHAS_VISITA', 'visit_dates')}) a JOIN "
          f"({_list_sql('(SELECT ID_TERCERO, lpad(CAST(dayofweek(FECHAS_VISITA) + 1 AS VARCHAR), 3, chr(48)) AS d FROM ' + VIS + ' y)', 'ID_TERCERO', 'd', 'weekdays')}) b "
          f"ON a.ID_TERCERO = b.ID_TERCERO")
def a02_distinct_list(spark, sf):
    """Two distinct-value lists per client at once (visit dates and
    weekday codes), from one scan."""
    from visitwise.operators.grouping import distinct_lists
    v = visits(spark, sf).withColumn("d", F.lpad(F.dayofweek("FECHAS_VISITA").cast("string"), 3, "0"))
    return distinct_lists(v, ["ID_TERCERO"], {
        "visit_dates": ("FECHAS_VISITA", lambda c: F.date_format(c, "yyyy-MM-dd")), "weekdays": ("d", None)})


@register("a03_first",
          f"SELECT ID_TERCERO, arg_min(Logintud, (Inicio_Visita, Logintud)) AS first_lon, min(Inicio_Visita) AS first_start "
          f"FROM ({D.VISITS_RAW_SQL}) v WHERE ID_TERCERO IS NOT NULL GROUP BY ID_TERCERO")
def a03_first(spark, sf):
    """First value per group in an explicit order (``min_by``), with the
    order's first value, in one aggregate."""
    v = D.visits_raw(spark, sf).where(F.col("ID_TERCERO").isNotNull())
    return v.groupBy("ID_TERCERO").agg(
        F.min_by("Logintud", F.struct("Inicio_Visita", "Logintud")).alias("first_lon"),
        F.min("Inicio_Visita").alias("first_start"))


_VR_COLS = ["Logintud", "Latitud", "Inicio_Visita", "Finalizacion_Visita", "Razon_Social_Cliente",
            "Nit", "Codigo_Sucursal", "Codigo_Vendedor", "Des_vendedor"]


@register("a04_dedup_first",
          f"SELECT ID_TERCERO, {', '.join(_VR_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY ID_TERCERO ORDER BY "
          f"{', '.join(c + ' ASC NULLS LAST' for c in ['Inicio_Visita'] + [c for c in _VR_COLS if c != 'Inicio_Visita'])}) AS rn "
          f"FROM ({D.VISITS_RAW_SQL}) v) s WHERE rn = 1")
def a04_dedup_first(spark, sf):
    """One visit per client - the earliest (ties by the other columns)."""
    from visitwise.operators.ranking import first_per_key
    v = D.visits_raw(spark, sf)
    order = [("Inicio_Visita", True)] + [(c, True) for c in _VR_COLS if c != "Inicio_Visita"]
    return first_per_key(v, ["ID_TERCERO"], order).select("ID_TERCERO", *_VR_COLS)


def _profile_sql():
    types = dict(_CLIENT_TYPES)
    parts = [f"SELECT '{c}' AS column_name, '{types[c]}' AS data_type, count({c}) AS non_null FROM ({D.CLIENTS_RAW_SQL}) c"
             for c in D.CLIENT_KEYS]
    return " UNION ALL ".join(parts)


@register("a07_profile", _profile_sql())
def a07_profile(spark, sf):
    """Type and non-null count of every client column (one pass)."""
    from visitwise.operators.grouping import profile
    return profile(D.clients_raw(spark, sf))


# ---------------------------------------------------- ranks, sorts, splits

_RANK_PART = "PARTITION BY ID_TERCERO, FECHAS_VISITA"
_RANK_GUARD = "ID_TERCERO IS NOT NULL AND FECHAS_VISITA IS NOT NULL"


@register("w01_dense_rank",
          f'SELECT ID_TERCERO, FECHAS_VISITA, Inicio_Visita, "Time", CAST(CASE WHEN {_RANK_GUARD} AND "Time" IS NOT NULL '
          f'THEN dense_rank() OVER ({_RANK_PART} ORDER BY "Time" DESC NULLS LAST) END AS INTEGER) AS Flag_Time FROM {FACTS}')
def w01_dense_rank(spark, sf):
    """Dense rank of the duration code per client and day (skew-safe)."""
    from visitwise.operators.ranking import grouped_rank
    f = facts(spark, sf).select("ID_TERCERO", "FECHAS_VISITA", "Inicio_Visita", "Time")
    return grouped_rank(f, ["ID_TERCERO", "FECHAS_VISITA"], "Time", "Flag_Time", "dense")


@register("w02_rank",
          f"SELECT ID_TERCERO, FECHAS_VISITA, Inicio_Visita, round(Distancia_Haversine, 3) AS Distancia_Haversine, "
          f"CAST(CASE WHEN {_RANK_GUARD} AND Distancia_Haversine IS NOT NULL THEN rank() OVER ({_RANK_PART} ORDER BY "
          f"Distancia_Haversine DESC NULLS LAST) END AS INTEGER) AS Flag_Distance FROM {FACTS}")
def w02_rank(spark, sf):
    """Competition rank of the distance, farthest first (skew-safe)."""
    from visitwise.operators.ranking import grouped_rank
    f = facts(spark, sf).select("ID_TERCERO", "FECHAS_VISITA", "Inicio_Visita", "Distancia_Haversine")
    return _round(grouped_rank(f, ["ID_TERCERO", "FECHAS_VISITA"], "Distancia_Haversine",
                               "Flag_Distance", "min"), "Distancia_Haversine")


_W03_ORDER = ["Inicio_Visita", "ID_TERCERO", "Logintud", "Latitud", "Finalizacion_Visita", "Razon_Social_Cliente", "Nit", "Codigo_Sucursal",
     "Codigo_Vendedor", "Des_vendedor"]


@register("w03_bucket",
          f"SELECT *, CAST(ntile(10) OVER (ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in _W03_ORDER)}) AS INTEGER) AS bucket "
          f"FROM ({D.VISITS_RAW_SQL}) v")
def w03_bucket(spark, sf):
    """Exact ``ntile(10)`` over the visits in time order, without a
    single-task window (range sort, per-partition counts, offsets)."""
    from visitwise.operators.ranking import balanced_buckets, order_col
    v = D.visits_raw(spark, sf)
    out = balanced_buckets(v, [order_col(c) for c in _W03_ORDER], 10, "bucket")
    return out.select(*v.columns, "bucket")


_O_COLS = ["ID_TERCERO", "Inicio_Visita", "Logintud", "Latitud", "TimeDifference"]
_O_ORDER = [("ID_TERCERO", True), ("Inicio_Visita", False), ("Logintud", True), ("Latitud", True), ("TimeDifference", True)]


def _sql_order(order, reverse=False):
    out = []
    for c, asc in order:
        if reverse:
            asc = not asc
        d = "ASC" if asc else "DESC"
        n = "NULLS FIRST" if reverse else "NULLS LAST"
        out.append(f"{c} {d} {n}")
    return ", ".join(out)


@register("o01_sort_limit",
          f"SELECT {', '.join(_O_COLS)} FROM {_LENGTHS} ORDER BY {_sql_order(_O_ORDER)} LIMIT 20")
def o01_sort_limit(spark, sf):
    """O01 + O02: mixed-direction sort, nulls last, first 20 rows (top-k)."""
    from visitwise.operators.ranking import head, order_col
    f = _lengths(spark, sf).select(*_O_COLS)
    return head(f, [order_col(c, a) for c, a in _O_ORDER], 20)


@register("o03_tail",
          f"SELECT {', '.join(_O_COLS)} FROM {_LENGTHS} ORDER BY {_sql_order(_O_ORDER, reverse=True)} LIMIT 20")
def o03_tail(spark, sf):
    """Last 20 rows of the same order."""
    from visitwise.operators.ranking import tail
    return tail(_lengths(spark, sf).select(*_O_COLS), _O_ORDER, 20)


# ------------------------------------------------------ export and designs

def _result_order_sql():
    from visitwise.plans.unified import RESULT_ORDER, TIE_BREAK
    from visitwise.schemas import RESULT_COLUMNS
    keys = [k for k, _ in RESULT_ORDER] + TIE_BREAK
    cols = [k for k in keys] + [c for c in RESULT_COLUMNS + ["is_scheduled", "duration_minutes", "Flag_Duracion"]
                                if c not in keys]
    return ", ".join(f'"{c}" ASC NULLS LAST' for c in cols)


_SPLIT_SQL = (f"SELECT * REPLACE (round(Distancia_Haversine, 3) AS Distancia_Haversine), CAST(ntile(3) OVER (ORDER BY "
              f"{_result_order_sql()}) AS INTEGER) AS part FROM ({D.unified_sql(round_distance=None)}) u")


def _split(spark, sf):
    """The split of the export: on the exact distance, rounded afterwards."""
    from visitwise.sources.sinks import split_parts
    from visitwise.plans.unified import ROW_ID, result_order
    res = unified(clients(spark, sf), calendar(spark, sf), visits(spark, sf), keep_row_id=True)
    parts = split_parts(res, result_order(res, row_id=True), 3, "part", row_id=ROW_ID)
    return _round(parts.drop(ROW_ID, "_row", "_nrows"), "Distancia_Haversine")


@register("s13_ntile_split", _SPLIT_SQL)
def s13_ntile_split(spark, sf):
    """S13 (Q10's split): the unified table in its export order, cut into 3
    contiguous parts whose sizes differ by at most one row."""
    return _split(spark, sf)


@register("s14_snapshot",
          f"SELECT s.*, strftime(last_day((SELECT CAST(max(ts) AS DATE) FROM events)), '%Y%m') AS period FROM ({_SPLIT_SQL}) s")
def s14_snapshot(spark, sf):
    """The rows that a run at the end of the latest visit's month writes
    under ``period=yyyyMM`` (the whole result, with its parts)."""
    from visitwise.functions import period_yyyymm
    latest = D.table(spark, sf, "events").agg(F.max(F.to_date("ts"))).first()[0]
    return _split(spark, sf).withColumn("period", period_yyyymm(F.last_day(F.lit(latest))))


@register("s14_month_end",
          f"SELECT strftime(FECHAS_VISITA, '%Y%m') AS period, count(*) AS n_rows, CAST(sum(Flag_DAN) AS BIGINT) AS n_visited, "
          f"last_day(min(FECHAS_VISITA)) AS month_end FROM ({D.unified_sql()}) u GROUP BY 1")
def s14_month_end(spark, sf):
    """Rows of the unified table per monthly period partition (what a
    month-end run writes under ``period=yyyyMM``) and the period's last day."""
    from visitwise.plans.unified import month_sizes
    return month_sizes(clients(spark, sf), calendar(spark, sf), visits(spark, sf))


def _q11_sql():
    keys = ["ID_TERCERO", "COD_DIA_VISITA", "DES_DIA_VISITA", "COD_FRECUENCIA_VISITA",
            "DES_FRECUENCIA_VISITA", "FECHAS_VISITA"]
    secs = ("CAST(floor((epoch_us(v.Finalizacion_Visita) - epoch_us(v.Inicio_Visita)) / 1000000.0) AS BIGINT)")
    ds = f"((({secs}) % 86400) + 86400) % 86400"
    length = (f"CASE WHEN {secs} IS NULL THEN '' ELSE CAST(CAST(floor({ds} / 3600) AS BIGINT) AS VARCHAR) || 'h:' || "
              f"CAST(CAST(floor(({ds} % 3600) / 60) AS BIGINT) AS VARCHAR) || ' min' END")
    lon, lat = "TRY_CAST(v.Logintud AS DOUBLE)", "TRY_CAST(v.Latitud_Visita AS DOUBLE)"
    dist = (f"CASE WHEN {lon} IS NULL OR {lat} IS NULL OR c.LONGITUD IS NULL OR c.LATITUD IS NULL THEN NULL "
            f"WHEN {lon} = 0 OR {lat} = 0 OR c.LONGITUD = 0 OR c.LATITUD = 0 THEN 0.0 "
            f"ELSE {D._hav(lon, lat, 'c.LONGITUD', 'c.LATITUD')} END")
    base = (f"SELECT v.ID_TERCERO, c.COD_DIA_VISITA, c.DES_DIA_VISITA, c.COD_FRECUENCIA_VISITA, c.DES_FRECUENCIA_VISITA, "
            f"v.FECHAS_VISITA, v.Inicio_Visita, EXISTS (SELECT 1 FROM {CAL} k WHERE k.COD_DIA_VISITA IS NOT DISTINCT FROM c.COD_DIA_VISITA "
            f"AND k.COD_FRECUENCIA_VISITA IS NOT DISTINCT FROM c.COD_FRECUENCIA_VISITA AND k.FECHAS_VISITA = v.FECHAS_VISITA) AS Cumple, "
            f"{length} AS TimeDifferenceD, {dist} AS Distancia_Haversine FROM {VIS} v JOIN {CL} c ON v.ID_TERCERO IS NOT DISTINCT FROM c.ID_TERCERO")
    due = (f"SELECT c.ID_TERCERO, c.COD_DIA_VISITA, c.DES_DIA_VISITA, c.COD_FRECUENCIA_VISITA, c.DES_FRECUENCIA_VISITA, k.FECHAS_VISITA "
           f"FROM {CL} c JOIN {CAL} k ON c.COD_DIA_VISITA = k.COD_DIA_VISITA AND c.COD_FRECUENCIA_VISITA = k.COD_FRECUENCIA_VISITA "
           f"WHERE c.ID_TERCERO IN (SELECT ID_TERCERO FROM {VIS} vv)")
    on = " AND ".join(f"d.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    co = ", ".join(f"COALESCE(d.{k}, b.{k}) AS {k}" for k in keys)
    # the matched rows, then one copy for every marked visit of the same client and date
    return (f"SELECT {', '.join('r.' + k for k in keys)}, r.Inicio_Visita, m.Cumple, COALESCE(r.TimeDifferenceD, '') AS TimeDifferenceD, "
            f"round(r.Distancia_Haversine, 3) AS Distancia_Haversine, "
            f"CASE WHEN r.Distancia_Haversine <= 200 THEN 'Dentro del Rango' WHEN r.Distancia_Haversine > 200 THEN 'Fuera del Rango' ELSE '' END AS Rango_Visita, "
            f"CASE WHEN r.Distancia_Haversine <= 200 THEN 'Si' WHEN r.Distancia_Haversine > 200 THEN 'Fuera del Rango' ELSE '' END AS Cumpl_Rutero "
            f"FROM (SELECT {co}, b.Inicio_Visita, b.TimeDifferenceD, b.Distancia_Haversine FROM ({due}) d FULL OUTER JOIN ({base}) b ON {on}) r "
            f"JOIN ({base}) m ON r.ID_TERCERO = m.ID_TERCERO AND r.FECHAS_VISITA = m.FECHAS_VISITA")


@register("q11_compliance", _q11_sql())
def q11_compliance(spark, sf):
    """Q11: the first compliance design - due rows of visited clients
    full-matched with visits, joined with the marked visits; length text,
    distance and both classes."""
    from visitwise.plans.compliance import compliance_v1
    cal = calendar(spark, sf)
    return _round(compliance_v1(clients(spark, sf), cal, visits(spark, sf)), "Distancia_Haversine")


@register("q12_grouped",
          f"SELECT j.*, COALESCE(x.n, 0) AS n_due_visit_dates FROM ({_J13_SQL}) j LEFT JOIN "
          f"(SELECT v.ID_TERCERO, count(DISTINCT v.FECHAS_VISITA) AS n FROM {VIS} v JOIN {CL} c ON v.ID_TERCERO = c.ID_TERCERO "
          f"JOIN {CAL} k ON k.COD_DIA_VISITA = c.COD_DIA_VISITA AND k.COD_FRECUENCIA_VISITA = c.COD_FRECUENCIA_VISITA "
          f"AND k.FECHAS_VISITA = v.FECHAS_VISITA GROUP BY v.ID_TERCERO) x ON j.ID_TERCERO = x.ID_TERCERO")
def q12_grouped(spark, sf):
    """Q12: visit dates against due dates as lists per client, plus how
    many visit dates were due."""
    from visitwise.plans.compliance import grouped_dates
    cal = calendar(spark, sf)
    return grouped_dates(clients(spark, sf), cal, visits(spark, sf))


_Q15_DUE = (f"SELECT c.ID_TERCERO, c.COD_DIA_VISITA, c.code AS COD_FRECUENCIA_VISITA, k.FECHAS_VISITA FROM "
            f"(SELECT *, '00' || CAST(CAST(COALESCE(COD_FRECUENCIA_VISITA, '0') AS BIGINT) AS VARCHAR) AS code FROM {CL} c0) c "
            f"JOIN {CAL} k ON k.COD_DIA_VISITA = c.COD_DIA_VISITA AND k.COD_FRECUENCIA_VISITA = c.code")
_Q15_VISITS = (f"SELECT v.ID_TERCERO, v.FECHAS_VISITA, v.Inicio_Visita, c.COD_CANAL FROM {VIS} v JOIN {CL} c "
               f"ON v.ID_TERCERO = c.ID_TERCERO")


def _q15_sql(how):
    return (f"SELECT COALESCE(d.ID_TERCERO, v.ID_TERCERO) AS ID_TERCERO, d.COD_DIA_VISITA, d.COD_FRECUENCIA_VISITA, "
            f"COALESCE(d.FECHAS_VISITA, v.FECHAS_VISITA) AS FECHAS_VISITA, v.Inicio_Visita, v.COD_CANAL "
            f"FROM ({_Q15_DUE}) d {how} JOIN ({_Q15_VISITS}) v ON d.ID_TERCERO = v.ID_TERCERO AND d.FECHAS_VISITA = v.FECHAS_VISITA")


@register("q15_first_version", _q15_sql("INNER"))
def q15_first_version(spark, sf):
    """Q15: the CSV-based first version (J11 inner): due dates by rebuilt codes
    (C24, C25, C22) met by visits with the client's channel."""
    from visitwise.plans.compliance import visits_on_due_dates
    return visits_on_due_dates(clients(spark, sf), calendar(spark, sf), visits(spark, sf))


@register("q15_outer_version", _q15_sql("FULL OUTER"))
def q15_outer_version(spark, sf):
    """Q15's later copy (J11 outer): due dates without a visit and visits
    without a due date stay."""
    from visitwise.plans.compliance import visits_on_due_dates
    return visits_on_due_dates(clients(spark, sf), calendar(spark, sf), visits(spark, sf), "outer")


@register("j08_left_suffixes",
          f"SELECT v.ID_TERCERO, v.Latitud AS Latitud_x, v.Inicio_Visita, c.LATITUD AS LATITUD_y, c.COD_CANAL "
          f"FROM ({D.VISITS_RAW_SQL}) v LEFT JOIN ({D.CLIENTS_RAW_SQL}) c ON v.ID_TERCERO = c.ID_TERCERO")
def j08_left_suffixes(spark, sf):
    """Visits left-joined with clients; columns of one name get suffixes."""
    from visitwise.operators.nullsafe import merge
    v = D.visits_raw(spark, sf).select("ID_TERCERO", "Latitud", "Inicio_Visita")
    return merge(v, D.clients_raw(spark, sf).select("ID_TERCERO", "LATITUD", "COD_CANAL"), ["ID_TERCERO"], "left")


def _dates_text(c):
    return F.array_join(F.transform(c, lambda d: F.date_format(d, "yyyy-MM-dd")), ",")


_CODED = f"(SELECT v.*, c.COD_DIA_VISITA, c.COD_FRECUENCIA_VISITA FROM {VIS} v JOIN {CL} c ON v.ID_TERCERO = c.ID_TERCERO)"
_J12_SQL = (f"SELECT ID_TERCERO, string_agg(strftime(FECHAS_VISITA, '%Y-%m-%d'), ',' ORDER BY FECHAS_VISITA) AS fechas_agrupadas, "
            f"arg_min_null(COD_DIA_VISITA, (Inicio_Visita, COD_DIA_VISITA)) AS COD_DIA_VISITA, "
            f"arg_min_null(COD_FRECUENCIA_VISITA, (Inicio_Visita, COD_DIA_VISITA)) AS COD_FRECUENCIA_VISITA FROM {_CODED} x GROUP BY ID_TERCERO")
_PLAN_SQL = (f"SELECT COD_DIA_VISITA, COD_FRECUENCIA_VISITA, string_agg(strftime(FECHAS_VISITA, '%Y-%m-%d'), ',' ORDER BY FECHAS_VISITA) "
             f"AS fechas_programadas FROM {CAL} k GROUP BY ALL")
_J14_SQL = (f"SELECT x.ID_TERCERO, x.COD_DIA_VISITA, x.COD_FRECUENCIA_VISITA, x.Inicio_Visita, x.FECHAS_VISITA, l.fechas_agrupadas, p.fechas_programadas "
            f"FROM {_CODED} x JOIN ({_J12_SQL}) l ON x.ID_TERCERO = l.ID_TERCERO AND x.COD_DIA_VISITA = l.COD_DIA_VISITA "
            f"AND x.COD_FRECUENCIA_VISITA = l.COD_FRECUENCIA_VISITA JOIN ({_PLAN_SQL}) p ON l.COD_DIA_VISITA = p.COD_DIA_VISITA "
            f"AND l.COD_FRECUENCIA_VISITA = p.COD_FRECUENCIA_VISITA")


@register("j12_lists_and_codes", _J12_SQL)
def j12_lists_and_codes(spark, sf):
    """Per client its visit dates (duplicates kept; shown as text) and the
    codes of its first visit."""
    from visitwise.plans.compliance import client_lists
    return client_lists(clients(spark, sf), visits(spark, sf)).withColumn(
        "fechas_agrupadas", _dates_text("fechas_agrupadas"))


@register("j14_visits_with_lists", _J14_SQL)
def j14_visits_with_lists(spark, sf):
    """One row per visit with its client's dates and its plan's due dates."""
    from visitwise.plans.compliance import visits_with_lists
    return visits_with_lists(clients(spark, sf), calendar(spark, sf), visits(spark, sf), _dates_text)


def _j15_sql(how):
    return (f"SELECT COALESCE(j.ID_TERCERO, d.ID_TERCERO) AS ID_TERCERO, j.COD_DIA_VISITA, j.COD_FRECUENCIA_VISITA, "
            f"COALESCE(j.Inicio_Visita, d.Inicio_Visita) AS Inicio_Visita, j.FECHAS_VISITA, j.fechas_agrupadas, j.fechas_programadas, "
            f"d.distancia FROM ({_J14_SQL}) j {how} JOIN ({_DIST_SQL}) d ON j.ID_TERCERO = d.ID_TERCERO AND j.Inicio_Visita = d.Inicio_Visita")


@register("j15_distances_inner", _j15_sql("INNER"))
def j15_distances_inner(spark, sf):
    """The visits of J14 with their distances (inner)."""
    from visitwise.plans.compliance import distances_joined
    return distances_joined(clients(spark, sf), calendar(spark, sf), visits(spark, sf), _distances(spark, sf), "inner", _dates_text)


@register("q13_distances_outer", _j15_sql("FULL OUTER"))
def q13_distances_outer(spark, sf):
    """The visits of J14 and the distances, full outer."""
    from visitwise.plans.compliance import distances_joined
    return distances_joined(clients(spark, sf), calendar(spark, sf), visits(spark, sf), _distances(spark, sf), "outer", _dates_text)


_ONE = "3-001"  # the client whose rows the filters show


@register("f08_key_filter", f"SELECT * FROM ({D.VISITS_RAW_SQL}) v WHERE ID_TERCERO = '{_ONE}'")
def f08_key_filter(spark, sf):
    """the rows of one literal key."""
    return D.visits_raw(spark, sf).where(F.col("ID_TERCERO") == _ONE)


@register("f11_filter_project", f"SELECT ID_TERCERO, Inicio_Visita, distancia FROM ({_DIST_SQL}) d WHERE ID_TERCERO = '{_ONE}'")
def f11_filter_project(spark, sf):
    """a filter on the key, then a projection."""
    return _distances(spark, sf).where(F.col("ID_TERCERO") == _ONE).select("ID_TERCERO", "Inicio_Visita", "distancia")


@register("j17_slices",
          f"SELECT v.ID_TERCERO, v.Inicio_Visita, v.Finalizacion_Visita, d.distancia FROM ({D.VISITS_RAW_SQL}) v JOIN ({_DIST_SQL}) d "
          f"ON v.ID_TERCERO = d.ID_TERCERO AND v.Inicio_Visita = d.Inicio_Visita WHERE v.ID_TERCERO = '{_ONE}'")
def j17_slices(spark, sf):
    """Natural join of two filtered slices."""
    left = f08_key_filter(spark, sf).select("ID_TERCERO", "Inicio_Visita", "Finalizacion_Visita")
    return left.join(f11_filter_project(spark, sf), ["ID_TERCERO", "Inicio_Visita"], "inner")


@register("c03_to_timestamp",
          "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS texto, CAST(date_trunc('second', ts) AS TIMESTAMP) AS momento FROM events")
def c03_to_timestamp(spark, sf):
    """Text to timestamp by a stated format."""
    from visitwise.functions import to_ts
    txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return D.table(spark, sf, "events").select(
        "event_id", txt.alias("texto"), to_ts(txt, "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("momento"))


@register("c22_code_text",
          "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '00' || CAST(c_nationkey AS VARCHAR) END AS codigo FROM customer")
def c22_code_text(spark, sf):
    """Code from text; the text ``NaN`` gives an empty code."""
    from visitwise.functions import code_from_text
    txt = F.when(F.col("c_custkey") % 5 == 0, F.lit("NaN")).otherwise(F.col("c_nationkey").cast("string"))
    return D.table(spark, sf, "customer").select("c_custkey", code_from_text(txt).alias("codigo"))


@register("c25_int_text",
          f"SELECT ID_TERCERO, CAST(CAST(COALESCE(COD_FRECUENCIA_VISITA, '0') AS BIGINT) AS VARCHAR) AS frecuencia FROM ({D.CLIENTS_RAW_SQL}) c")
def c25_int_text(spark, sf):
    """C24 + C25: a missing code becomes 0, codes become whole numbers as text."""
    from visitwise.functions import fill_blank, int_text
    c = fill_blank(D.clients_raw(spark, sf).select("ID_TERCERO", "COD_FRECUENCIA_VISITA"), "0")
    return c.select("ID_TERCERO", int_text("COD_FRECUENCIA_VISITA").alias("frecuencia"))


@register("c29_first_element",
          f"SELECT ID_TERCERO, min(FECHAS_VISITA) AS primera FROM {VIS} v WHERE ID_TERCERO IS NOT NULL GROUP BY ID_TERCERO")
def c29_first_element(spark, sf):
    """First element of a list cell (the sorted visit dates)."""
    from visitwise.functions import first_element
    from visitwise.operators.grouping import value_list
    lists = value_list(visits(spark, sf), ["ID_TERCERO"], "FECHAS_VISITA", "fechas")
    return lists.select("ID_TERCERO", first_element("fechas").alias("primera"))


# ------------------------------------------------------ client extract (Q01)

def _extract_sources(spark, sf):
    """Source tables of the client extract derived from ``customer``: third
    party and customer rows, one entity movement row each (entity 181, 201,
    or 999 outside the kept list), EAV coordinates with an attribute-0 row
    for every 17th customer, attribute definitions, criteria of four plans
    and their descriptions."""
    c = D.table(spark, sf, "customer")
    k = F.col("c_custkey")
    cia = F.when(k % 11 == 0, F.lit(3)).otherwise(F.lit(2))
    ent = F.when(k % 13 == 0, F.lit(999)).when(k % 2 == 0, F.lit(181)).otherwise(F.lit(201))
    t200 = c.select(cia.alias("F200_ID_CIA"), k.alias("F200_ROWID"), k.cast("string").alias("F200_NIT"),
                    F.col("c_name").alias("F200_RAZON_SOCIAL"))
    t201 = c.select(cia.alias("F201_ID_CIA"), k.alias("F201_ROWID_TERCERO"), F.lit("001").alias("F201_ID_SUCURSAL"),
                    F.concat(F.lit("Sucursal "), F.col("c_mktsegment")).alias("F201_DESCRIPCION_SUCURSAL"),
                    F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("F201_IND_ESTADO_ACTIVO"),
                    F.lit("001").alias("F201_ID_CO_FACTURA"), (k + 100000).alias("F201_ROWID_MOVTO_ENTIDAD"))
    t750 = c.select((k + 100000).alias("F750_ROWID"))
    t752 = c.select((k + 200000).alias("F752_ROWID"), (k + 100000).alias("F752_ROWID_MOVTO_ENTIDAD"),
                    ent.alias("F752_ROWID_ENTIDAD"))
    t742 = t752.select(F.col("F752_ROWID_ENTIDAD").alias("F742_ROWID")).distinct()
    lon_attr = F.when(ent == 201, F.lit(901)).otherwise(F.lit(881))
    lat_attr = F.when(ent == 201, F.lit(902)).otherwise(F.lit(882))
    rows = F.array(
        F.struct(lon_attr.alias("a"), F.concat(F.lit("-74,"), F.lpad((k * 37 % 10000).cast("string"), 4, "0")).alias("t")),
        F.struct(lat_attr.alias("a"), F.concat(F.lit("4,"), F.lpad((k * 53 % 10000).cast("string"), 4, "0")).alias("t")),
        F.struct(F.when(k % 17 == 0, F.lit(0)).alias("a"), F.lit("ruido").alias("t")))
    t753 = (c.select(ent.alias("F753_ROWID_ENTIDAD"), (k + 200000).alias("F753_ROWID_MOVTO_ENTIDAD_FILA"),
                     (k + 100000).alias("F753_ROWID_MOVTO_ENTIDAD"), F.explode(rows).alias("r"))
            .where(F.col("r.a").isNotNull())
            .select("F753_ROWID_ENTIDAD", "F753_ROWID_MOVTO_ENTIDAD_FILA", "F753_ROWID_MOVTO_ENTIDAD",
                    F.col("r.a").alias("F753_ROWID_ENTIDAD_ATRIBUTO"), F.col("r.t").alias("F753_DATO_TEXTO")))
    defs = (t753.where(F.col("F753_ROWID_ENTIDAD_ATRIBUTO") != 0)
            .select(F.col("F753_ROWID_ENTIDAD_ATRIBUTO").alias("F743_ROWID"),
                    F.col("F753_ROWID_ENTIDAD").alias("F743_ROWID_ENTIDAD")))
    t743 = defs.unionByName(t742.select(F.lit(950).alias("F743_ROWID"),
                                        F.col("F742_ROWID").alias("F743_ROWID_ENTIDAD"))).distinct()
    crit, _ = _criteria(spark, sf)
    ck = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), cia.alias("cia"))
    crit = crit.join(ck, "custkey")
    t207 = crit.select(F.col("cia").alias("F207_ID_CIA"), F.col("custkey").alias("F207_ROWID_TERCERO"),
                       F.lit("001").alias("F207_ID_SUCURSAL"), F.col("plan").alias("F207_ID_PLAN_CRITERIOS"),
                       F.col("crit").alias("F207_ID_CRITERIO_MAYOR"))
    _, desc = _criteria(spark, sf)
    # descriptions per company for the (company, plan, criterion) that occur
    t206 = (crit.select("cia", "plan", "crit").distinct().join(desc, ["plan", "crit"])
            .select(F.col("cia").alias("F206_ID_CIA"), F.col("plan").alias("F206_ID_PLAN"),
                    F.col("crit").alias("F206_ID"), F.col("descr").alias("F206_DESCRIPCION")))
    t204 = t206.select(F.col("F206_ID_CIA").alias("F204_ID_CIA"), F.col("F206_ID_PLAN").alias("F204_ID")).distinct()
    return dict(t200=t200, t201=t201, t750=t750, t752=t752, t742=t742, t753=t753, t743=t743,
                t207=t207, t206=t206, t204=t204)


def _q01_sql():
    """From what the source tables say of a customer: one movement row with an
    entity, attribute values on it, and one criterion for each plan."""
    return f"""
WITH client AS (
  SELECT *, CASE WHEN c_custkey % 11 = 0 THEN 3 ELSE 2 END AS company,
         CASE WHEN c_custkey % 13 = 0 THEN 999 WHEN c_custkey % 2 = 0 THEN 181 ELSE 201 END AS entity
  FROM customer),
attribute AS (
  SELECT c_custkey, entity, unnest([
    {{'id': CASE WHEN entity = 201 THEN 901 ELSE 881 END, 'txt': '-74,' || lpad(CAST(c_custkey * 37 % 10000 AS VARCHAR), 4, '0')}},
    {{'id': CASE WHEN entity = 201 THEN 902 ELSE 882 END, 'txt': '4,' || lpad(CAST(c_custkey * 53 % 10000 AS VARCHAR), 4, '0')}},
    {{'id': CASE WHEN c_custkey % 17 = 0 THEN 0 END, 'txt': 'ruido'}}]) AS a
  FROM client),
defined AS (
  SELECT DISTINCT entity, unnest([a.id, 950]) AS id FROM attribute WHERE a.id <> 0),
coordinate AS (
  -- a value counts once for each defined attribute it meets: its own, or for
  -- id 0 every attribute of the entity that is none of the coordinate's
  SELECT c_custkey, axis, a.txt FROM attribute JOIN defined USING (entity)
  CROSS JOIN (VALUES ('lon', [881, 901]), ('lat', [882, 902])) wanted(axis, ids)
  WHERE a.id = CASE WHEN list_contains(ids, defined.id) THEN defined.id ELSE 0 END),
criterion AS (
  SELECT custkey AS c_custkey,
         max(crit) FILTER (plan = '001') AS day_code, max(descr) FILTER (plan = '001') AS day,
         max(crit) FILTER (plan = '002') AS freq_code, max(descr) FILTER (plan = '002') AS freq,
         max(crit) FILTER (plan = 'VEN') AS seller_code, max(descr) FILTER (plan = 'VEN') AS seller,
         max(descr) FILTER (plan = 'CCD') AS channel
  FROM {_CRIT_SQL} k JOIN {_desc_sql()} d USING (plan, crit) GROUP BY custkey)
SELECT company AS COD_CIA, c_custkey AS ROWID_TERCERO, CAST(c_custkey AS VARCHAR) AS NIT_TERCERO,
       CAST(c_custkey AS VARCHAR) || '-001' AS ID_TERCERO, c_name AS RAZON_SOCIAL, '001' AS COD_SUCURSAL_CLIENTE,
       'Sucursal ' || c_mktsegment AS DES_SUCURSAL_CLIENTE, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS IND_ESTADO_ACTIVO_CLIENTE,
       day_code AS COD_DIA_VISITA, day AS DES_DIA_VISITA, '001' AS COD_CO, freq_code AS COD_FRECUENCIA_VISITA,
       freq AS DES_FRECUENCIA_VISITA, seller_code AS COD_VENDEDOR, seller AS DES_VENDEDOR, channel AS COD_CANAL,
       x.txt AS LONGITUD, y.txt AS LATITUD
FROM client JOIN coordinate x USING (c_custkey) JOIN coordinate y USING (c_custkey) LEFT JOIN criterion USING (c_custkey)
WHERE company = 2 AND entity IN (181, 201) AND x.axis = 'lon' AND y.axis = 'lat'"""


@register("q01_client_extract", _q01_sql())
def q01_client_extract(spark, sf):
    """Q01: the 18-column client extract over EAV, criteria and customer
    tables (J20-J23, F06, C26-C28, P01), on source tables derived from
    ``customer``."""
    from visitwise.plans.extract import client_extract
    return client_extract(**_extract_sources(spark, sf))


@register("a05_distinct",
          f"SELECT DISTINCT COD_CANAL, COD_FRECUENCIA_VISITA FROM ({D.CLIENTS_RAW_SQL}) c")
def a05_distinct(spark, sf):
    """Distinct values (channel and frequency code pairs)."""
    return D.clients_raw(spark, sf).select("COD_CANAL", "COD_FRECUENCIA_VISITA").distinct()


# queries beyond the reference's own register themselves
from visitwise.plans import beyond  # noqa: E402, F401
