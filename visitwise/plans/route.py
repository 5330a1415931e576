"""Due list (Q07) and visit facts (Q08).

Rewrite R1 (SURVEY 4): the reference full-joins clients with the calendar
and left-joins visits with clients, then drops rows without a client at the
very end.  Rows without a client can never meet a row with one (every key
of the final natural join includes the client row), so the same result
comes from ``left`` (due list) and ``inner`` (visit facts) joins, with no
filter at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitwise.functions.coords import guarded_distance, range_class, to_number
from visitwise.functions.durations import (duration_seconds, length_text,
                                           time_code)
from visitwise.operators.nullsafe import merge

CAL_KEYS = ["COD_DIA_VISITA", "COD_FRECUENCIA_VISITA"]


def due_list(clients: DataFrame, calendar: DataFrame, *more: str) -> DataFrame:
    """One row per client and due date; clients whose codes match
    no calendar row keep one row with a null date.

    Whether the calendar is broadcast is the planner's choice, from its size,
    unless the caller hints it. ``more``: other columns of the calendar to keep.
    """
    return merge(clients, calendar.select("FECHAS_VISITA", *CAL_KEYS, *more), CAL_KEYS, "left")


def calendar_copies(calendar: DataFrame) -> DataFrame:
    """The distinct rows of the calendar, ``_copies`` of each (so few that any
    join with it can make many rows of a client, but none twice)."""
    return calendar.groupBy("FECHAS_VISITA", *CAL_KEYS).agg(F.count(F.lit(1)).alias("_copies"))


def visit_facts(visits: DataFrame, clients: DataFrame, compat: bool = True, null_safe: bool = True) -> DataFrame:
    """Q08 / J02 (inner after R1) with C09-C15.

    ``TimeDifference`` is in seconds; ``TimeDifferenceD`` the ``1h:5 min``
    text (sentinel for a missing end with ``compat``); ``Time`` the
    reference's glued code; ``Distancia_Haversine`` in metres with the zero
    guard; ``Rango_Visita`` the 200 m class. Without ``null_safe`` ids that
    are null meet nothing, and the join is on the bare column, so tables
    bucketed by it need no shuffle.
    """
    j = merge(visits, clients, ["ID_TERCERO"], "inner", null_safe=null_safe)
    secs = duration_seconds("Inicio_Visita", "Finalizacion_Visita")
    j = j.withColumn("TimeDifference", secs)
    lon, lat = to_number("Logintud"), to_number("Latitud_Visita")
    j = j.withColumns({
        "TimeDifferenceD": length_text("TimeDifference", compat=compat),
        "Time": time_code("TimeDifference"),
        "Logintud": lon,
        "Latitud_Visita": lat,
    })
    j = j.withColumn("Distancia_Haversine",
                     guarded_distance("Logintud", "Latitud_Visita", "LONGITUD", "LATITUD"))
    return j.withColumn("Rango_Visita", range_class("Distancia_Haversine"))
