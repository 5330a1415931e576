"""Unified statistics (Q09) and its export (Q10).

Plan shape (see ``explain``): clients x calendar -> due list;
visits x clients -> facts; the natural full outer match of the two is
built from aggregates and joins that adaptive execution can split
(``operators.matching``); the two ranks use the skew-safe histogram ranks
(``operators.ranking``).  No step needs one whole client-day in one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitwise.functions.codes import equal_flag, not_null_flag
from visitwise.functions.text import clean_text
from visitwise.operators.matching import natural_full_outer
from visitwise.functions.durations import duration_minutes
from visitwise.operators.ranking import attach_stacked_ranks, materialize, order_col
from visitwise.plans.prepare import prepare_calendar, prepare_clients, prepare_visits
from visitwise.plans.route import CAL_KEYS, calendar_copies, due_list, visit_facts
from visitwise.schemas import CLEANED_TEXT, RESULT_COLUMNS

RANK_KEYS = ["ID_TERCERO", "FECHAS_VISITA"]
# Final sort of the reference (only the last of its three sorts is visible).
RESULT_ORDER = [("ID_TERCERO", True), ("FECHAS_VISITA", True),
                ("Distancia_Haversine", True), ("Flag_Time", True)]
# Of rows that these leave tied, the order of start and client row.
TIE_BREAK = ["Inicio_Visita", "ROWID_TERCERO"]
ROW_ID = "_rid"


def with_clean_text(clients: DataFrame) -> DataFrame:
    """C19 once per client row (a dimension), not once per result row.

    The cleaned text rides along as extra columns; the raw columns stay the
    match keys, so two clients that differ only by accents never merge.
    """
    return clients.withColumns({f"_clean_{c}": clean_text(c) for c in CLEANED_TEXT})


def client_dimension(clients: DataFrame, clean: bool = True) -> DataFrame:
    """Distinct client rows with ``_m`` (how many identical copies the input
    held), a surrogate ``_cid`` and the cleaned text, written once to the
    checkpoint folder (so ``_cid`` is stable and text is cleaned once).

    The natural joins of the reference match on all client columns; two
    rows meet exactly when they are copies of one distinct client row, so
    matching on ``_cid`` with the copy counts gives the same rows.
    """
    d = (clients.groupBy(*clients.columns).agg(F.count(F.lit(1)).alias("_m"))
         .withColumn("_cid", F.monotonically_increasing_id()))
    return materialize(with_clean_text(d) if clean else d)


def duplicate_clients(clients: DataFrame) -> DataFrame:
    """Client rows present more than once (kept by the job, which multiplies
    their due dates and visits exactly as the reference does): the row's
    id columns and how many copies there are."""
    return (clients.groupBy(*clients.columns).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1)
            .select("ROWID_TERCERO", "ID_TERCERO", "copies"))


def match_due_visits(clients: DataFrame, calendar: DataFrame, visits: DataFrame) -> DataFrame:
    """J01 + J02 + J03 (after R1) on narrow keys.

    Due list and visit facts are built on ``(_cid, date)``; their natural
    full outer match is the skew-safe one of ``operators.matching``; the
    client attributes join back last (a dimension: broadcast or shuffled
    by the planner from its measured size).  Adds ``_matched``.
    """
    dim = client_dimension(clients)
    return _match(dim, calendar, visits).join(dim.drop("_m"), "_cid", "inner")


def _match(dim: DataFrame, calendar: DataFrame, visits: DataFrame) -> DataFrame:
    """The match on ``_cid`` and date, without the clients' attributes.

    A calendar row counts with its copies, so a client and a date are one due
    row: nothing is left to group after the join, which makes many dates of
    each client. The calendar (at most a row per day and code pair) is
    broadcast: on its few codes a shuffle would gather the clients in few tasks.
    """
    due = due_list(dim.select("_cid", "_m", *CAL_KEYS), F.broadcast(calendar_copies(calendar)), "_copies") \
        .select("_cid", (F.col("_m") * F.coalesce("_copies", F.lit(1))).alias("_m"), "FECHAS_VISITA")
    facts = visit_facts(visits, dim.select("_cid", "_m", "ID_TERCERO", "LONGITUD", "LATITUD")) \
        .drop("ID_TERCERO", "LONGITUD", "LATITUD")
    return natural_full_outer(due, facts, ["_cid", "FECHAS_VISITA"], matched_flag="_matched",
                              due_mult="_m", fact_mult="_m", due_distinct=True)


def month_sizes(clients: DataFrame, calendar: DataFrame, visits: DataFrame) -> DataFrame:
    """Rows and visited rows of the unified table per month, and the
    month's end: counted from the match alone, without ranks, attributes or
    cleaned text."""
    from visitwise.functions.dates import period_yyyymm
    dim = client_dimension(clients, clean=False)
    return (_match(dim, calendar, visits).groupBy(period_yyyymm("FECHAS_VISITA").alias("period"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(not_null_flag("Inicio_Visita")).cast("long").alias("n_visited"),
                 F.last_day(F.min("FECHAS_VISITA")).alias("month_end")))


def unified(clients: DataFrame, calendar: DataFrame, visits: DataFrame,
            extras: bool = True, keep_row_id: bool = False) -> DataFrame:
    """Q09 from prepared inputs.

    Output: the 33 columns of the reference (``RESULT_COLUMNS``), with
    ranks as integers and ``TimeDifference`` in seconds, plus (``extras``)
    the corrected forms of two reference defects: ``is_scheduled`` - the
    visit's date was due for that client (what ``Flag_Visita_Rutero`` was
    meant to say) - and ``Flag_Duracion``, the dense rank of the visit
    length in whole minutes (``duration_minutes``), longest first, next to
    ``Flag_Time``, which ranks the reference's glued hour-minute code.
    ``keep_row_id`` adds the stored rows' unique number, for a split that sorts
    narrow rows.
    """
    # the matched table feeds the rank histograms and the rank lookups:
    # write it once (with a row id that stays fixed from then on)
    res = materialize(match_due_visits(clients, calendar, visits)
                      .withColumn(ROW_ID, F.monotonically_increasing_id())
                      .withColumn("duration_minutes", duration_minutes("TimeDifference").cast("int")))
    specs = [("Time", "Flag_Time", "dense", True),
             ("Distancia_Haversine", "Flag_Distance", "min", True),
             ("duration_minutes", "Flag_Duracion", "dense", True)]
    res = attach_stacked_ranks(res, ROW_ID, RANK_KEYS, specs, store=keep_row_id)
    res = res.withColumns({
        "Flag_DAN": not_null_flag("Inicio_Visita"),
        "Flag_Visita_Rutero": equal_flag("FECHAS_VISITA", "FECHAS_VISITA_V"),
        "is_scheduled": F.col("_matched") & F.col("FECHAS_VISITA").isNotNull(),
    })
    out = []
    for c in RESULT_COLUMNS:
        if c in CLEANED_TEXT:
            out.append(F.col(f"_clean_{c}").alias(c))
        else:
            out.append(F.col(c))
    if extras:
        out += ["is_scheduled", "duration_minutes", "Flag_Duracion"]
    if keep_row_id:
        out.append(ROW_ID)
    return res.select(*out)


def unified_statistics(clients_raw: DataFrame, calendar_wide: DataFrame,
                       visits_raw: DataFrame, year: int) -> DataFrame:
    """Q04-Q09 end to end."""
    return unified(prepare_clients(clients_raw), prepare_calendar(calendar_wide),
                   prepare_visits(visits_raw, year))


def result_order(df: DataFrame, row_id: bool = False) -> list:
    """Sort of the export: the reference's keys, nulls last, then start and
    client row, then every other column, so that the order (and the split) is
    total; with ``row_id`` the rest is left to the row id."""
    keys = [k for k, _ in RESULT_ORDER] + TIE_BREAK
    rest = [] if row_id else [c for c in df.columns if c not in keys]
    return [order_col(k, asc) for k, asc in RESULT_ORDER] + [order_col(c) for c in TIE_BREAK + rest]


def is_month_end(as_of: _dt.date) -> bool:
    """``as_of`` is the last day of its month."""
    return (as_of + _dt.timedelta(days=1)).day == 1


__all__ = ["unified", "unified_statistics", "match_due_visits", "client_dimension",
           "duplicate_clients",
           "result_order", "is_month_end"]
