"""Declared schemas of the three inputs (clients, visits, calendar).

Columns are selected by name everywhere; ``conform`` fails on a missing
column instead of shifting positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, I, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()

CLIENTS = T.StructType([
    T.StructField("COD_CIA", I), T.StructField("ROWID_TERCERO", L, False),
    T.StructField("NIT_TERCERO", S), T.StructField("ID_TERCERO", S),
    T.StructField("RAZON_SOCIAL", S), T.StructField("COD_SUCURSAL_CLIENTE", S),
    T.StructField("DES_SUCURSAL_CLIENTE", S), T.StructField("IND_ESTADO_ACTIVO_CLIENTE", I),
    T.StructField("COD_DIA_VISITA", S), T.StructField("DES_DIA_VISITA", S),
    T.StructField("COD_CO", S), T.StructField("COD_FRECUENCIA_VISITA", S),
    T.StructField("DES_FRECUENCIA_VISITA", S), T.StructField("COD_VENDEDOR", S),
    T.StructField("DES_VENDEDOR", S), T.StructField("COD_CANAL", S),
    T.StructField("LONGITUD", S), T.StructField("LATITUD", S),
])
CLIENT_COLUMNS = CLIENTS.fieldNames()

VISITS = T.StructType([
    T.StructField("Logintud", S), T.StructField("Latitud", S),
    T.StructField("Inicio_Visita", TS), T.StructField("Finalizacion_Visita", TS),
    T.StructField("Razon_Social_Cliente", S), T.StructField("ID_TERCERO", S),
    T.StructField("Nit", S), T.StructField("Codigo_Sucursal", S),
    T.StructField("Codigo_Vendedor", S), T.StructField("Des_vendedor", S),
])
VISIT_COLUMNS = VISITS.fieldNames()

CALENDAR_FILE = T.StructType([T.StructField(n, S) for n in (
    "FECHA", "COD_DIA VISITA", "DIA VISITA", "COD SEMANAL", "SEMANAL",
    "COD QUINCENAL", "QUINCENAL ", "COD MENSUAL", "MENSUAL")])

# Text columns cleaned in the unified result.
CLEANED_TEXT = ["RAZON_SOCIAL", "DES_SUCURSAL_CLIENTE", "DES_DIA_VISITA", "DES_VENDEDOR"]

# Unified result: client columns, due date, visit facts, flags.
# The visit's ``Latitud`` is renamed ``Latitud_Visita``: it differs from the
# client's ``LATITUD`` only by case, and Spark (like SQL) resolves names
# without case.  The CSV sink writes the reference's header back.
VISIT_FACT_COLUMNS = ["Logintud", "Latitud_Visita", "Inicio_Visita", "Finalizacion_Visita",
                      "FECHAS_VISITA_V", "TimeDifference", "TimeDifferenceD", "Time",
                      "Distancia_Haversine", "Rango_Visita"]
FLAG_COLUMNS = ["Flag_Time", "Flag_Distance", "Flag_DAN", "Flag_Visita_Rutero"]
RESULT_COLUMNS = CLIENT_COLUMNS + ["FECHAS_VISITA"] + VISIT_FACT_COLUMNS + FLAG_COLUMNS


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the schema's columns by name; fail if one is missing."""
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[df[have[f.name.lower()]].cast(f.dataType).alias(f.name)
                       for f in schema.fields])
