"""Compliance designs of the exploratory notebooks (Q11, Q12, Q14, Q15).

All built from the prepared inputs of ``plans.prepare``; every join is an
equi-join. Lists of due dates are bounded by the calendar; a client's list of
visit dates keeps duplicates where the reference does, so it is as long as the
client has visits. Such lists are built once per client and meet the visits in
the last join, so no shuffle carries a list per visit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitwise.functions.codes import code_from_text, int_text
from visitwise.functions.coords import guarded_distance, range_class, range_class_si, to_number
from visitwise.functions.durations import duration_seconds, length_text
from visitwise.operators.grouping import distinct_list, value_list
from visitwise.operators.matching import mark_join, natural_full_outer
from visitwise.operators.nullsafe import merge
from visitwise.operators.ranking import first_per_key, materialize
from visitwise.plans.route import calendar_copies

CODE_KEYS = ["COD_DIA_VISITA", "COD_FRECUENCIA_VISITA"]
DUE_KEYS = ["ID_TERCERO", "COD_DIA_VISITA", "DES_DIA_VISITA", "COD_FRECUENCIA_VISITA",
            "DES_FRECUENCIA_VISITA", "FECHAS_VISITA"]


def distinct_clients(clients: DataFrame) -> DataFrame:
    """One client row per id (the first by its remaining columns)."""
    rest = [c for c in clients.columns if c != "ID_TERCERO"]
    return first_per_key(clients, ["ID_TERCERO"], [(c, True) for c in rest])


def due_rows(clients: DataFrame, calendar: DataFrame, *more: str) -> DataFrame:
    """Clients x calendar, inner on day and frequency code (``more``:
    other columns of the calendar to keep)."""
    return clients.join(calendar.select("FECHAS_VISITA", *CODE_KEYS, *more), CODE_KEYS, "inner")


def mark_scheduled(visits: DataFrame, calendar: DataFrame, flag: str = "Cumple") -> DataFrame:
    """Flag each visit whose (day code, frequency code, date) is in the
    calendar."""
    return mark_join(visits, calendar, CODE_KEYS + ["FECHAS_VISITA"], flag)


def compliance_v1(clients: DataFrame, calendar: DataFrame, visits: DataFrame) -> DataFrame:
    """Q11. Visits meet the full client table; the due rows are those of
    clients with visits (one row each, A04). Both are full-matched on client,
    codes and date, then joined with the marked visits (J19) on client and date
    (J07), so repeated visits of one day multiply and due rows without a visit
    go. Length text with ``''`` for a missing end (C12 as the first design had
    it), distance, and both distance classes (C15, C16)."""
    base = merge(visits, clients, ["ID_TERCERO"], "inner")
    due = due_rows(distinct_clients(base.select(*[k for k in DUE_KEYS if k != "FECHAS_VISITA"])),
                   calendar_copies(calendar), "_copies")
    facts = base.select(*DUE_KEYS, "Inicio_Visita", "Finalizacion_Visita", "Logintud", "Latitud_Visita",
                        "LONGITUD", "LATITUD")
    marks = (mark_scheduled(base.select("ID_TERCERO", "FECHAS_VISITA", *CODE_KEYS), calendar)
             .select("ID_TERCERO", "FECHAS_VISITA", "Cumple"))
    res = natural_full_outer(due.select(*DUE_KEYS, "_copies"), facts, DUE_KEYS, due_mult="_copies", due_distinct=True).join(marks, ["ID_TERCERO", "FECHAS_VISITA"])
    dist = guarded_distance(to_number("Logintud"), to_number("Latitud_Visita"), "LONGITUD", "LATITUD")
    length = length_text(duration_seconds("Inicio_Visita", "Finalizacion_Visita"))
    res = res.select(*DUE_KEYS, "Inicio_Visita", "Cumple", F.coalesce(length, F.lit("")).alias("TimeDifferenceD"),
                     dist.alias("Distancia_Haversine"))
    return (res.withColumn("Rango_Visita", range_class("Distancia_Haversine"))
            .withColumn("Cumpl_Rutero", range_class_si("Distancia_Haversine")))


def grouped_dates(clients: DataFrame, calendar: DataFrame, visits: DataFrame) -> DataFrame:
    """Per client, its distinct visit dates and the due dates of
    its plan (calendar grouped by codes), both as sorted text, plus how
    many visit dates were due."""
    dfmt = lambda c: F.date_format(c, "yyyy-MM-dd")
    vis = distinct_list(visits, ["ID_TERCERO"], "FECHAS_VISITA", "visit_dates", dfmt)
    plan = distinct_list(calendar, CODE_KEYS, "FECHAS_VISITA", "due_dates", dfmt)
    cl = clients.select("ID_TERCERO", *CODE_KEYS).distinct()
    j = cl.join(vis, "ID_TERCERO", "inner").join(plan, CODE_KEYS, "inner")
    on_due = (mark_scheduled(visits.join(cl, "ID_TERCERO", "inner")
                             .select("ID_TERCERO", "FECHAS_VISITA", *CODE_KEYS).distinct(),
                             calendar, "_due")
              .where("_due").groupBy("ID_TERCERO").agg(F.count(F.lit(1)).alias("n_due_visit_dates")))
    return (j.join(on_due, "ID_TERCERO", "left")
            .withColumn("n_due_visit_dates", F.coalesce("n_due_visit_dates", F.lit(0)).cast("long")))


def client_lists(clients: DataFrame, visits: DataFrame) -> DataFrame:
    """Per client with visits, the dates of all its visits as an array
    (duplicates kept) and the codes of its first visit, one row each."""
    coded = visits.join(clients.select("ID_TERCERO", *CODE_KEYS), "ID_TERCERO", "inner")
    dates = value_list(coded, ["ID_TERCERO"], "FECHAS_VISITA", "fechas_agrupadas")
    order = F.struct("Inicio_Visita", *CODE_KEYS)
    codes = coded.groupBy("ID_TERCERO").agg(*[F.min_by(c, order).alias(c) for c in CODE_KEYS])
    return dates.join(codes, "ID_TERCERO", "left")


LIST_KEYS = ["ID_TERCERO", *CODE_KEYS]


def plan_lists(clients: DataFrame, calendar: DataFrame, visits: DataFrame, cell=F.col) -> DataFrame:
    """One row per client: its visit dates (J12) and the due dates of its plan
    (J13: joined on the two codes), each put through ``cell`` once."""
    plan = value_list(calendar, CODE_KEYS, "FECHAS_VISITA", "fechas_programadas")
    both = client_lists(clients, visits).join(plan, CODE_KEYS, "inner")
    return both.select(*LIST_KEYS, *[cell(c).alias(c) for c in ("fechas_agrupadas", "fechas_programadas")])


def _coded_visits(clients: DataFrame, visits: DataFrame) -> DataFrame:
    return (visits.join(clients.select(*LIST_KEYS), "ID_TERCERO", "inner")
            .select(*LIST_KEYS, "Inicio_Visita", "FECHAS_VISITA"))


def visits_with_lists(clients: DataFrame, calendar: DataFrame, visits: DataFrame, cell=F.col) -> DataFrame:
    """One row per visit with its client's list of visit dates and the
    list of due dates of its plan. The lists travel once per client."""
    lists = plan_lists(clients, calendar, visits, cell)
    return _coded_visits(clients, visits).join(lists, LIST_KEYS, "inner")


def distances_joined(clients: DataFrame, calendar: DataFrame, visits: DataFrame, distances: DataFrame, how: str,
                     cell=F.col) -> DataFrame:
    """J15 (inner) and J16 (full outer): the visits of J14 and a table of
    distances by client and start. Narrow visits that have lists meet the
    distances first, the lists come last."""
    first = visits.join(clients.select(*LIST_KEYS), "ID_TERCERO", "inner")
    order = F.struct("Inicio_Visita", *CODE_KEYS)
    with_list = first.groupBy("ID_TERCERO").agg(*[F.min_by(c, order).alias(c) for c in CODE_KEYS])
    with_list = with_list.join(calendar.select(*CODE_KEYS).distinct(), CODE_KEYS, "left_semi")
    rows = _coded_visits(clients, visits).join(with_list, LIST_KEYS, "left_semi")
    met = merge(rows, distances, ["ID_TERCERO", "Inicio_Visita"], how)
    # a distance without a visit has no codes, so no list
    out = met.join(plan_lists(clients, calendar, visits, cell), LIST_KEYS, "left")
    others = [c for c in distances.columns if c not in ("ID_TERCERO", "Inicio_Visita")]
    return out.select(*LIST_KEYS, "Inicio_Visita", "FECHAS_VISITA", "fechas_agrupadas", "fechas_programadas", *others)


def frequency_code(c) -> Column:
    """The code steps of Q15: missing becomes 0 (C24), a whole number as text
    (C25), ``00`` in front (C22)."""
    return code_from_text(int_text(F.coalesce(F.col(c).cast("long"), F.lit(0))))


def visits_on_due_dates(clients: DataFrame, calendar: DataFrame, visits: DataFrame, how: str = "inner") -> DataFrame:
    """Q15 (J08-J11): the due dates of clients (one row each, by the frequency
    code rebuilt as text) and the visits with their client's channel, joined on
    client and date: ``inner``, or ``outer`` for the later copy."""
    one = materialize(distinct_clients(clients).select(*LIST_KEYS, "COD_CANAL"))  # read by both sides
    cl = one.withColumn("COD_FRECUENCIA_VISITA", frequency_code("COD_FRECUENCIA_VISITA"))
    due = due_rows(cl, calendar).select("ID_TERCERO", *CODE_KEYS, "FECHAS_VISITA")
    v = visits.join(one.select("ID_TERCERO", "COD_CANAL"), "ID_TERCERO", "inner").select(
        "ID_TERCERO", "FECHAS_VISITA", "Inicio_Visita", "COD_CANAL")
    return merge(due, v, ["ID_TERCERO", "FECHAS_VISITA"], how)


def all_due_dates(clients: DataFrame, calendar: DataFrame, visits: DataFrame) -> DataFrame:
    """Every visit against every due date of its client's plan
    (bounded fan-out: at most the calendar's dates per visit). ``Cumple`` is
    the visit's own mark (J19), carried through the join; ``es_su_fecha`` says
    that this due date is the visit's date."""
    # a client's different plans, gathered by client alone: one shuffle, whose partitioning the join uses again
    plans = clients.groupBy("ID_TERCERO").agg(F.collect_set(F.struct(*[F.col(c) for c in CODE_KEYS])).alias("_plans"))
    v = (visits.select("ID_TERCERO", "Inicio_Visita", "FECHAS_VISITA").join(plans, "ID_TERCERO", "inner")
         .withColumn("_plan", F.explode("_plans")).select("ID_TERCERO", "Inicio_Visita", "FECHAS_VISITA", "_plan.*"))
    cal = calendar.select(F.col("FECHAS_VISITA").alias("FECHA_PROGRAMADA"), *CODE_KEYS)
    return (mark_scheduled(v, calendar).join(cal, CODE_KEYS, "inner")
            .select("ID_TERCERO", "Inicio_Visita", "FECHA_PROGRAMADA", "Cumple",
                    (F.col("FECHA_PROGRAMADA") == F.col("FECHAS_VISITA")).alias("es_su_fecha")))
