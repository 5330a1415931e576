"""Input preparation: clients (Q04), calendar (Q05), visits (Q06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitwise.functions.coords import coord_text, to_number
from visitwise.functions.dates import year_range_filter
from visitwise.operators.calendar import unpivot_calendar
from visitwise.schemas import CLIENTS, VISITS, conform

# Channels kept and the active flag.
CHANNELS = ("OFF", "ON")
ACTIVE = 1


def prepare_clients(clients: DataFrame, channels=CHANNELS) -> DataFrame:
    """Q04: active clients of the kept channels (F01, F02) with numeric
    coordinates (C01 then C02)."""
    c = conform(clients, CLIENTS)
    return (c.where(F.col("COD_CANAL").isin(*channels))
             .where(F.col("IND_ESTADO_ACTIVO_CLIENTE") == ACTIVE)
             .withColumns({"LONGITUD": to_number(coord_text("LONGITUD")),
                           "LATITUD": to_number(coord_text("LATITUD"))}))


def prepare_calendar(wide: DataFrame) -> DataFrame:
    """Q05: (FECHAS_VISITA date, COD_DIA_VISITA, COD_FRECUENCIA_VISITA)."""
    return unpivot_calendar(wide)


def prepare_visits(visits: DataFrame, year: int | None = None) -> DataFrame:
    """Q06: visits started in ``year`` (range filter on the raw timestamp,
    pushed to the scan; every year if none is given), coordinates as cut
    text, visit date twice. A visit without a start belongs to no year."""
    v = conform(visits, VISITS)
    d = F.to_date("Inicio_Visita")
    in_year = F.col("Inicio_Visita").isNotNull() if year is None else year_range_filter("Inicio_Visita", year)
    return (v.where(in_year)
             .select("ID_TERCERO",
                     coord_text("Logintud").alias("Logintud"),
                     coord_text("Latitud").alias("Latitud_Visita"),
                     "Inicio_Visita", "Finalizacion_Visita",
                     d.alias("FECHAS_VISITA"), d.alias("FECHAS_VISITA_V")))
