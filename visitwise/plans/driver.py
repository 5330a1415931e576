"""Domain mapping of the driver's tables, in Spark and in SQL.

The driver ships TPC-H-like tables, not the reference's extracts, so the
three inputs are derived from them by fixed expressions, written once for
Spark (``clients_raw``/``visits_raw``) and once as DuckDB SQL (the ``*_SQL``
texts) for the oracle:

* clients  <- ``customer``: id ``<custkey>-001``, day code from
  ``custkey % 7``, frequency code from ``custkey % 8`` (``000`` -> null,
  so null keys are exercised), channel ON/OFF from two market segments,
  active when the balance is positive, coordinates as comma text (latitude
  missing for every 97th client);
* visits   <- ``events``: client ``<user_id>-001``, start ``ts``, end
  ``ts + round(value * 60)`` seconds (missing for ``error`` events),
  coordinates near the client's (``0`` for every 101st event);
* calendar <- the calendar rule for every year that ``events`` has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.operators.calendar import (BIWEEKLY_LABELS, DAY_LABELS,
                                          MONTHLY_LABELS, WEEKLY_LABEL,
                                          calendar_for_years)

FREQ_LABELS = [WEEKLY_LABEL] + BIWEEKLY_LABELS + MONTHLY_LABELS
ON_SEGMENT, OFF_SEGMENT = "BUILDING", "FURNITURE"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (listed afresh, so a rewritten table is read as it is)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _label(code, labels):
    return F.element_at(F.array(*[F.lit(x) for x in labels]), code.cast("int"))


def clients_raw(spark: SparkSession, sf_dir: str, kept_only: bool = False) -> DataFrame:
    """The 18 client columns.  ``kept_only`` adds the raw-column predicates
    implied by the client preparation (channel ON/OFF, active), so they
    reach the parquet scan; the preparation still applies its own filter."""
    c = table(spark, sf_dir, "customer")
    if kept_only:
        c = c.where(F.col("c_mktsegment").isin(ON_SEGMENT, OFF_SEGMENT, "ON", "OFF")
                    & (F.col("c_acctbal") > 0))
    k = F.col("c_custkey")
    day = F.lpad((k % 7 + 1).cast("string"), 3, "0")
    fq = k % 8
    freq = F.when(fq != 0, F.lpad(fq.cast("string"), 3, "0"))
    seg = F.col("c_mktsegment")
    return c.select(
        F.lit(2).alias("COD_CIA"),
        k.alias("ROWID_TERCERO"),
        k.cast("string").alias("NIT_TERCERO"),
        F.concat(k.cast("string"), F.lit("-001")).alias("ID_TERCERO"),
        F.col("c_name").alias("RAZON_SOCIAL"),
        F.lit("001").alias("COD_SUCURSAL_CLIENTE"),
        F.concat(F.lit("Sucursal "), seg).alias("DES_SUCURSAL_CLIENTE"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("IND_ESTADO_ACTIVO_CLIENTE"),
        day.alias("COD_DIA_VISITA"),
        _label(day, DAY_LABELS).alias("DES_DIA_VISITA"),
        F.lit("001").alias("COD_CO"),
        freq.alias("COD_FRECUENCIA_VISITA"),
        F.when(fq != 0, _label(fq, FREQ_LABELS)).alias("DES_FRECUENCIA_VISITA"),
        F.col("c_nationkey").cast("string").alias("COD_VENDEDOR"),
        F.concat(F.lit("Vendedor "), F.col("c_nationkey").cast("string")).alias("DES_VENDEDOR"),
        F.when(seg == ON_SEGMENT, F.lit("ON")).when(seg == OFF_SEGMENT, F.lit("OFF"))
         .otherwise(seg).alias("COD_CANAL"),
        F.concat(F.lit("-74,"), F.lpad((k * 37 % 10000).cast("string"), 4, "0")).alias("LONGITUD"),
        F.when(k % 97 != 0, F.concat(F.lit("4,"), F.lpad((k * 53 % 10000).cast("string"), 4, "0")))
         .alias("LATITUD"),
    )


def visits_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    u, i = F.col("user_id"), F.col("event_id")
    end = F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60))
    return e.select(
        F.when(i % 101 == 0, F.lit("0")).otherwise(
            F.concat(F.lit("-74,"), F.lpad(((u * 37 + i % 50) % 10000).cast("string"), 4, "0")))
         .alias("Logintud"),
        F.concat(F.lit("4,"), F.lpad(((u * 53 + i % 50) % 10000).cast("string"), 4, "0"))
         .alias("Latitud"),
        F.col("ts").alias("Inicio_Visita"),
        F.when(F.col("event_type") != "error", end).alias("Finalizacion_Visita"),
        F.concat(F.lit("Cliente "), u.cast("string")).alias("Razon_Social_Cliente"),
        F.concat(u.cast("string"), F.lit("-001")).alias("ID_TERCERO"),
        u.cast("string").alias("Nit"),
        F.lit("001").alias("Codigo_Sucursal"),
        (u % 25).cast("string").alias("Codigo_Vendedor"),
        F.concat(F.lit("Vendedor "), (u % 25).cast("string")).alias("Des_vendedor"),
    )


def calendar_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated calendar of every year that ``events`` has."""
    years = table(spark, sf_dir, "events").select(F.year("ts").alias("year")).where("year is not null")
    return calendar_for_years(years)


# ---------------------------------------------------------------- SQL side

def _case(expr: str, labels: list[str]) -> str:
    arms = " ".join(f"WHEN {i + 1} THEN '{x}'" for i, x in enumerate(labels))
    return f"CASE CAST({expr} AS INTEGER) {arms} END"


CLIENTS_RAW_SQL = f"""
SELECT 2 AS COD_CIA, c_custkey AS ROWID_TERCERO, CAST(c_custkey AS VARCHAR) AS NIT_TERCERO,
  CAST(c_custkey AS VARCHAR) || '-001' AS ID_TERCERO, c_name AS RAZON_SOCIAL,
  '001' AS COD_SUCURSAL_CLIENTE, 'Sucursal ' || c_mktsegment AS DES_SUCURSAL_CLIENTE,
  CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS IND_ESTADO_ACTIVO_CLIENTE,
  lpad(CAST(c_custkey % 7 + 1 AS VARCHAR), 3, '0') AS COD_DIA_VISITA,
  {_case('c_custkey % 7 + 1', DAY_LABELS)} AS DES_DIA_VISITA,
  '001' AS COD_CO,
  CASE WHEN c_custkey % 8 <> 0 THEN lpad(CAST(c_custkey % 8 AS VARCHAR), 3, '0') END AS COD_FRECUENCIA_VISITA,
  CASE WHEN c_custkey % 8 <> 0 THEN {_case('c_custkey % 8', FREQ_LABELS)} END AS DES_FRECUENCIA_VISITA,
  CAST(c_nationkey AS VARCHAR) AS COD_VENDEDOR, 'Vendedor ' || CAST(c_nationkey AS VARCHAR) AS DES_VENDEDOR,
  CASE WHEN c_mktsegment = '{ON_SEGMENT}' THEN 'ON' WHEN c_mktsegment = '{OFF_SEGMENT}' THEN 'OFF'
       ELSE c_mktsegment END AS COD_CANAL,
  '-74,' || lpad(CAST(c_custkey * 37 % 10000 AS VARCHAR), 4, '0') AS LONGITUD,
  CASE WHEN c_custkey % 97 <> 0 THEN '4,' || lpad(CAST(c_custkey * 53 % 10000 AS VARCHAR), 4, '0') END AS LATITUD
FROM customer"""

VISITS_RAW_SQL = """
SELECT
  CASE WHEN event_id % 101 = 0 THEN '0'
       ELSE '-74,' || lpad(CAST((user_id * 37 + event_id % 50) % 10000 AS VARCHAR), 4, '0') END AS Logintud,
  '4,' || lpad(CAST((user_id * 53 + event_id % 50) % 10000 AS VARCHAR), 4, '0') AS Latitud,
  ts AS Inicio_Visita,
  CASE WHEN event_type <> 'error' THEN ts + to_seconds(CAST(round(value * 60) AS BIGINT)) END AS Finalizacion_Visita,
  'Cliente ' || CAST(user_id AS VARCHAR) AS Razon_Social_Cliente,
  CAST(user_id AS VARCHAR) || '-001' AS ID_TERCERO,
  CAST(user_id AS VARCHAR) AS Nit, '001' AS Codigo_Sucursal,
  CAST(user_id % 25 AS VARCHAR) AS Codigo_Vendedor,
  'Vendedor ' || CAST(user_id % 25 AS VARCHAR) AS Des_vendedor
FROM events"""


_DAYS_SQL = ("SELECT CAST(d AS DATE) AS d FROM (SELECT DISTINCT year(ts) AS y FROM events WHERE ts IS NOT NULL) ys, "
             "generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY) t(d)")


def calendar_wide_sql() -> str:
    """Calendar rule in SQL, for every year that ``events`` has."""
    return f"""
SELECT d AS FECHA,
  lpad(CAST(dayofweek(d) + 1 AS VARCHAR), 3, '0') AS COD_DIA_VISITA,
  {_case('dayofweek(d) + 1', DAY_LABELS)} AS DES_DIA_VISITA,
  '001' AS COD_SEMANAL, '{WEEKLY_LABEL}' AS SEMANAL,
  CASE WHEN w % 2 = 0 THEN '002' ELSE '003' END AS COD_QUINCENAL,
  {_case('w % 2 + 1', BIWEEKLY_LABELS)} AS QUINCENAL,
  lpad(CAST(w + 4 AS VARCHAR), 3, '0') AS COD_MENSUAL,
  {_case('w + 1', MONTHLY_LABELS)} AS MENSUAL
FROM (SELECT d, CAST(((floor(date_diff('day', DATE '2022-12-26', d) / 7) % 4) + 4) % 4 AS INTEGER) AS w
      FROM ({_DAYS_SQL}) days)"""


def calendar_long_sql(wide: str) -> str:
    return f"""
SELECT FECHA AS FECHAS_VISITA, COD_DIA_VISITA, 'COD_SEMANAL' AS TIPO_CODIGO, COD_SEMANAL AS COD_FRECUENCIA_VISITA FROM ({wide}) w1
UNION ALL SELECT FECHA, COD_DIA_VISITA, 'COD_QUINCENAL', COD_QUINCENAL FROM ({wide}) w2
UNION ALL SELECT FECHA, COD_DIA_VISITA, 'COD_MENSUAL', COD_MENSUAL FROM ({wide}) w3"""


def _num(x: str) -> str:
    # C01 + C02 in SQL
    return f"TRY_CAST(substr(replace({x}, ',', '.'), 1, 8) AS DOUBLE)"


CLIENTS_SQL = f"""
SELECT * REPLACE ({_num('LONGITUD')} AS LONGITUD, {_num('LATITUD')} AS LATITUD)
FROM ({CLIENTS_RAW_SQL}) cr
WHERE COD_CANAL IN ('OFF', 'ON') AND IND_ESTADO_ACTIVO_CLIENTE = 1"""


def visits_sql(where: str = "Inicio_Visita IS NOT NULL") -> str:
    return f"""
SELECT ID_TERCERO, substr(replace(Logintud, ',', '.'), 1, 8) AS Logintud,
  substr(replace(Latitud, ',', '.'), 1, 8) AS Latitud_Visita, Inicio_Visita, Finalizacion_Visita,
  CAST(Inicio_Visita AS DATE) AS FECHAS_VISITA, CAST(Inicio_Visita AS DATE) AS FECHAS_VISITA_V
FROM ({VISITS_RAW_SQL}) vr
WHERE {where}"""


CLIENT_KEYS = ["COD_CIA", "ROWID_TERCERO", "NIT_TERCERO", "ID_TERCERO", "RAZON_SOCIAL",
               "COD_SUCURSAL_CLIENTE", "DES_SUCURSAL_CLIENTE", "IND_ESTADO_ACTIVO_CLIENTE",
               "COD_DIA_VISITA", "DES_DIA_VISITA", "COD_CO", "COD_FRECUENCIA_VISITA",
               "DES_FRECUENCIA_VISITA", "COD_VENDEDOR", "DES_VENDEDOR", "COD_CANAL",
               "LONGITUD", "LATITUD"]


def due_sql() -> str:
    cal = calendar_long_sql(calendar_wide_sql())
    return f"""
SELECT cl.*, cal.FECHAS_VISITA FROM ({CLIENTS_SQL}) cl LEFT JOIN ({cal}) cal
  ON cl.COD_DIA_VISITA IS NOT DISTINCT FROM cal.COD_DIA_VISITA
 AND cl.COD_FRECUENCIA_VISITA IS NOT DISTINCT FROM cal.COD_FRECUENCIA_VISITA"""


def _hav(lon1, lat1, lon2, lat2) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(greatest(1 - {a}, 0.0)))) * 1000)"


def facts_sql() -> str:
    other = [c for c in CLIENT_KEYS if c != "ID_TERCERO"]
    secs = ("CAST(floor((epoch_us(v.Finalizacion_Visita) - epoch_us(v.Inicio_Visita)) "
            "/ 1000000.0) AS BIGINT)")
    return f"""
SELECT *, CASE WHEN Distancia_Haversine <= 200 THEN 'Dentro del Rango'
               WHEN Distancia_Haversine > 200 THEN 'Fuera del Rango' ELSE '' END AS Rango_Visita
FROM (
 SELECT *, CASE WHEN Logintud IS NULL OR Latitud_Visita IS NULL OR LONGITUD IS NULL OR LATITUD IS NULL THEN NULL
                WHEN Logintud = 0 OR Latitud_Visita = 0 OR LONGITUD = 0 OR LATITUD = 0 THEN 0.0
                ELSE {_hav('Logintud', 'Latitud_Visita', 'LONGITUD', 'LATITUD')} END AS Distancia_Haversine
 FROM (
  SELECT *, CASE WHEN TimeDifference IS NULL THEN 'nanh:nan min' ELSE
              CAST(CAST(floor(ds / 3600) AS BIGINT) AS VARCHAR) || 'h:' ||
              CAST(CAST(floor((ds % 3600) / 60) AS BIGINT) AS VARCHAR) || ' min' END AS TimeDifferenceD,
            CAST(CAST(CAST(floor(ds / 3600) AS BIGINT) AS VARCHAR) ||
                 CAST(CAST(floor((ds % 3600) / 60) AS BIGINT) AS VARCHAR) AS DOUBLE) AS "Time"
  FROM (
   SELECT v.ID_TERCERO, TRY_CAST(v.Logintud AS DOUBLE) AS Logintud,
          TRY_CAST(v.Latitud_Visita AS DOUBLE) AS Latitud_Visita,
          v.Inicio_Visita, v.Finalizacion_Visita, v.FECHAS_VISITA, v.FECHAS_VISITA_V,
          {', '.join('c.' + c for c in other)},
          {secs} AS TimeDifference, ((({secs}) % 86400) + 86400) % 86400 AS ds
   FROM ({visits_sql()}) v JOIN ({CLIENTS_SQL}) c ON v.ID_TERCERO IS NOT DISTINCT FROM c.ID_TERCERO
  ) s1
 ) s2
) s3"""


FACT_COLUMNS_SQL = ["ID_TERCERO", "Logintud", "Latitud_Visita", "Inicio_Visita",
                    "Finalizacion_Visita", "FECHAS_VISITA", "FECHAS_VISITA_V"] + \
    [c for c in CLIENT_KEYS if c != "ID_TERCERO"] + \
    ["TimeDifference", "TimeDifferenceD", "Time", "Distancia_Haversine", "Rango_Visita"]


def _clean(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^a-zA-Z0-9\\s]', '', 'g')"


def unified_sql(round_distance: int | None = 3) -> str:
    part = "PARTITION BY ID_TERCERO, FECHAS_VISITA"
    guard = "ID_TERCERO IS NOT NULL AND FECHAS_VISITA IS NOT NULL"
    from visitwise.schemas import CLEANED_TEXT
    out = []
    for k in CLIENT_KEYS:
        out.append(f"{_clean(k)} AS {k}" if k in CLEANED_TEXT else k)
    dist = (f"round(Distancia_Haversine, {round_distance})" if round_distance is not None
            else "Distancia_Haversine")
    out += ["FECHAS_VISITA", "Logintud", "Latitud_Visita", "Inicio_Visita",
            "Finalizacion_Visita", "FECHAS_VISITA_V", "TimeDifference", "TimeDifferenceD",
            '"Time"', f"{dist} AS Distancia_Haversine", "Rango_Visita",
            f'CAST(CASE WHEN {guard} AND "Time" IS NOT NULL THEN dense_rank() OVER ({part} ORDER BY "Time" DESC NULLS LAST) END AS INTEGER) AS Flag_Time',
            f"CAST(CASE WHEN {guard} AND Distancia_Haversine IS NOT NULL THEN rank() OVER ({part} ORDER BY Distancia_Haversine DESC NULLS LAST) END AS INTEGER) AS Flag_Distance",
            "CASE WHEN Inicio_Visita IS NULL THEN 0 ELSE 1 END AS Flag_DAN",
            "CASE WHEN FECHAS_VISITA = FECHAS_VISITA_V THEN 1 ELSE 0 END AS Flag_Visita_Rutero",
            "(_d IS NOT NULL AND FECHAS_VISITA IS NOT NULL) AS is_scheduled",
            "CAST(floor(TimeDifference / 60) AS INTEGER) AS duration_minutes",
            f"CAST(CASE WHEN {guard} AND TimeDifference IS NOT NULL THEN dense_rank() OVER ({part} ORDER BY floor(TimeDifference / 60) DESC NULLS LAST) END AS INTEGER) AS Flag_Duracion"]
    return f"""
SELECT {', '.join(out)} FROM ({matched_sql()}) j"""


def matched_sql() -> str:
    """Due list FULL OUTER JOIN visit facts on the 19 natural keys."""
    keys = CLIENT_KEYS + ["FECHAS_VISITA"]
    on = " AND ".join(f"d.{k} IS NOT DISTINCT FROM f.{k}" for k in keys)
    coalesced = ", ".join(f"COALESCE(d.{k}, f.{k}) AS {k}" for k in keys)
    facts_only = ["Logintud", "Latitud_Visita", "Inicio_Visita", "Finalizacion_Visita",
                  "FECHAS_VISITA_V", "TimeDifference", "TimeDifferenceD", "Time",
                  "Distancia_Haversine", "Rango_Visita"]
    fcols = ", ".join(f'f."{c}"' for c in facts_only)
    return f"""
  SELECT {coalesced}, {fcols}, d._d
  FROM (SELECT *, 1 AS _d FROM ({due_sql()}) d0) d
  FULL OUTER JOIN ({facts_sql()}) f ON {on}"""
