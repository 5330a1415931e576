"""Queries beyond the reference's own: as-of and interval joins, windows,
running frames, grouping sets, mergeable sketches, multisets and snapshots on
the driver's tables. Registered with the others (``plans.registry``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.operators import intervals, rollups, scans, setops
from visitwise.plans import driver as D
from visitwise.plans import registry as R
from visitwise.plans.registry import register
from visitwise.streaming import windows as W

MONEY = "decimal(18,2)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their value as an exact decimal, so that sums do not depend on their order."""
    e = D.table(spark, sf, "events")
    return e.select("event_id", "ts", "user_id", "event_type", F.col("value").cast(MONEY).alias("value"))


EVENTS = "(SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events)"


# ------------------------------------------------------------- as-of joins

@register("t01_asof_order", """
SELECT e.event_id, e.user_id, e.ts, o.o_orderkey, o.o_orderdate, o.o_totalprice
FROM events e ASOF LEFT JOIN (
  SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY 1, 2) o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate""")
def t01_asof_order(spark, sf):
    """Each visit with its client's latest order at that time."""
    orders = D.table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey", "o_totalprice")
    return scans.asof_join(events(spark, sf).select("event_id", "user_id", "ts"), orders, ["user_id"], "ts", "o_orderdate",
                           "o_orderkey", left_tie="event_id")


@register("t02_asof_tolerance", """
SELECT p.event_id, p.user_id, p.ts, CASE WHEN p.ts - v.ts <= INTERVAL 6 HOUR THEN v.event_id END AS view_event_id,
  CASE WHEN p.ts - v.ts <= INTERVAL 6 HOUR THEN v.ts END AS view_ts
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (
  SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v
  ON p.user_id = v.user_id AND p.ts >= v.ts""")
def t02_asof_tolerance(spark, sf):
    """Each purchase with the same client's latest view of the last six hours."""
    e = events(spark, sf)
    view = e.where("event_type = 'view'").select("user_id", "ts", "event_id")
    return scans.asof_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), view, ["user_id"],
                           "ts", "ts", "event_id", dt.timedelta(hours=6), "event_id", prefix="view_")


# ---------------------------------------------------- interval and range joins

def seller_visits(spark, sf) -> DataFrame:
    """Finished visits as intervals of their seller."""
    end = F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60))
    return (D.table(spark, sf, "events").where("event_type <> 'error'")
            .select((F.col("user_id") % 25).alias("seller"), "event_id", F.col("ts").alias("visit_start"), end.alias("visit_end")))


SELLER_VISITS = ("(SELECT user_id % 25 AS seller, event_id, ts AS visit_start, "
                 "ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS visit_end FROM events WHERE event_type <> 'error')")


@register("t03_overlapping_visits", f"""
SELECT a.seller, a.event_id AS event_id_1, b.event_id AS event_id_2,
  CAST(floor((epoch_us(least(a.visit_end, b.visit_end)) - epoch_us(b.visit_start)) / 1000000) AS BIGINT) AS overlap_seconds
FROM {SELLER_VISITS} a JOIN {SELLER_VISITS} b ON a.seller = b.seller AND a.visit_start <= b.visit_start
  AND b.visit_start < a.visit_end AND b.visit_start < b.visit_end AND (a.visit_start, a.event_id) < (b.visit_start, b.event_id)""")
def t03_overlapping_visits(spark, sf):
    """Pairs of one seller's visits that overlap in time, and for how long."""
    from visitwise.functions.durations import duration_seconds
    pairs = intervals.overlapping_pairs(seller_visits(spark, sf), ["seller"], "visit_start", "visit_end", "event_id")
    return pairs.select("seller", "event_id_1", "event_id_2",
                        duration_seconds("visit_start_2", F.least("visit_end_1", "visit_end_2")).alias("overlap_seconds"))


@register("t04_range_join", f"""
SELECT c.event_id, c.user_id, v.event_id AS visit_event_id
FROM (SELECT * FROM events WHERE event_type = 'error') c LEFT JOIN {SELLER_VISITS} v
  ON c.user_id % 25 = v.seller AND v.visit_start <= c.ts AND c.ts < v.visit_end""")
def t04_range_join(spark, sf):
    """Each failed visit with the visits that its seller was on at that time."""
    failed = (D.table(spark, sf, "events").where("event_type = 'error'")
              .select((F.col("user_id") % 25).alias("seller"), "event_id", "user_id", "ts"))
    out = intervals.range_join(failed, seller_visits(spark, sf), ["seller"], "ts", "visit_start", "visit_end",
                               interval_prefix="visit_", how="left")
    return out.select("event_id", "user_id", "visit_event_id")


# ---------------------------------------------------------- event-time windows

def _per_window() -> dict:
    return {"n": F.count(F.lit(1)), "total": F.sum("value").cast("double"), "longest": F.max("value").cast("double")}


_PER_WINDOW = "count(*) AS n, CAST(sum(value) AS DOUBLE) AS total, CAST(max(value) AS DOUBLE) AS longest"
_TUMBLING = (f"SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, "
             f"{_PER_WINDOW} FROM {EVENTS} WHERE ts IS NOT NULL GROUP BY 1, 2, 3")


@register("t05_tumbling_windows", _TUMBLING)
def t05_tumbling_windows(spark, sf):
    """Visits per hour and kind."""
    return W.event_windows(events(spark, sf), "ts", ["event_type"], "1 hour", **_per_window())


@register("t06_sliding_windows", f"""
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, event_type, {_PER_WINDOW}
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * unnest(range(4)) AS BIGINT)) AS w FROM {EVENTS}) GROUP BY 1, 2, 3""")
def t06_sliding_windows(spark, sf):
    """Visits per day and kind, a new day every six hours."""
    return W.event_windows(events(spark, sf), "ts", ["event_type"], "1 day", "6 hours", **_per_window())


SESSION_GAP = 7200


@register("t07_sessions", f"""
SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS session_start, max(ts) + to_seconds({SESSION_GAP}) AS session_end, {_PER_WINDOW}
FROM (SELECT *, sum(CASE WHEN ts - before < to_seconds({SESSION_GAP}) THEN 0 ELSE 1 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM {EVENTS} WHERE ts IS NOT NULL))
GROUP BY 1, 2""")
def t07_sessions(spark, sf):
    """Each client's runs of visits less than two hours apart."""
    return scans.sessions(events(spark, sf), ["user_id"], "ts", "event_id", SESSION_GAP, **_per_window())


@register("t08_stream_windows", _TUMBLING)
def t08_stream_windows(spark, sf):
    """t05 by a stream over the landed events, with watermark and state."""
    import uuid

    from visitwise.session import ensure_checkpoint_dir
    folder = f"{ensure_checkpoint_dir(spark)}/windows-{uuid.uuid4().hex}"
    schema = D.table(spark, sf, "events").schema
    # a stream reads folders or patterns: this one matches the table alone, file or folder
    stream = W.event_stream(spark, f"{sf}/events.parque[t]", schema, "ts", "1 hour")
    stream = stream.withColumn("value", F.col("value").cast(MONEY))
    found = W.event_windows(stream, "ts", ["event_type"], "1 hour", **_per_window())
    W.run_windows(found, f"{folder}/out", f"{folder}/state")
    out = W.latest(spark, f"{folder}/out", found.schema, ["window_start", "window_end", "event_type"])
    return out.withColumns({c: W.wall_clock(c) for c in ("window_start", "window_end")})


# -------------------------------------------------------------- running frames

@register("t09_running_frames", f"""
SELECT event_id, user_id, ts, row_number() OVER w AS visit_number,
  CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000) AS BIGINT) AS seconds_since, lead(ts) OVER w AS next_ts,
  CAST(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total_so_far,
  CAST(sum(value) OVER m AS DOUBLE) / count(value) OVER m AS mean_of_three
FROM {EVENTS} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
  m AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING)""")
def t09_running_frames(spark, sf):
    """Per visit of a client: its number, the gap to the one before, the next
    one, the running total and the mean of the last three."""
    from visitwise.functions.durations import duration_seconds
    keys, order = ["user_id"], ["ts", "event_id"]
    seg = scans.segments(events(spark, sf).withColumn("_one", F.lit(1)), keys, order)
    seg = scans.framed(seg, keys, order, 2, 1, {
        "_before": lambda w: F.lag("ts").over(w), "next_ts": lambda w: F.lead("ts").over(w),
        "_sum": lambda w: F.sum("value").over(w.rowsBetween(-2, 0)), "_n": lambda w: F.count("value").over(w.rowsBetween(-2, 0))})
    out = scans.running_totals(seg, keys, order, {"visit_number": "_one", "total_so_far": "value"})
    return out.select("event_id", "user_id", "ts", "visit_number", duration_seconds("_before", "ts").alias("seconds_since"),
                      "next_ts", F.col("total_so_far").cast("double").alias("total_so_far"),
                      (F.col("_sum").cast("double") / F.col("_n")).alias("mean_of_three"))


# --------------------------------------------------------------- grouping sets

DIMS = ["region", "segment", "month"]


def _sales(spark, sf):
    o = D.table(spark, sf, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("month"),
                                            F.col("o_totalprice").cast(MONEY).alias("price"))
    c = D.table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    n = D.table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = D.table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(*DIMS, "price"))


def _sales_sql(by: str) -> str:
    return f"""
SELECT region, segment, month, CAST(grouping(region, segment, month) AS BIGINT) AS grouping_id, count(*) AS n, count(price) AS n_price,
  CAST(sum(price) AS DOUBLE) AS sum_price, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
  CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
FROM (SELECT r_name AS region, c_mktsegment AS segment, strftime(o_orderdate, '%Y%m') AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS price
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
GROUP BY {by}"""


def _grouped(spark, sf, sets) -> DataFrame:
    out = rollups.grouping_sets(rollups.grain_states(_sales(spark, sf), DIMS, ["price"]), DIMS, sets, ["price"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("sum_price", "min_price", "max_price")})


@register("t10_cube", _sales_sql("CUBE (region, segment, month)"))
def t10_cube(spark, sf):
    """Sales by every combination of region, segment and month."""
    return _grouped(spark, sf, rollups.cube_sets(DIMS))


@register("t11_rollup", _sales_sql("ROLLUP (region, segment, month)"))
def t11_rollup(spark, sf):
    """Sales by region, segment and month with subtotals."""
    return _grouped(spark, sf, rollups.rollup_sets(DIMS))


@register("t12_grouping_sets", _sales_sql("GROUPING SETS ((region, month), (segment), ())"))
def t12_grouping_sets(spark, sf):
    """Sales by region and month, by segment, and in all."""
    return _grouped(spark, sf, [["region", "month"], ["segment"], []])


# -------------------------------------------------------------------- sketches

_SECONDS = "CAST(round(value * 60) AS BIGINT)"


@register("t13_sketch_months", f"""
SELECT strftime(ts, '%Y%m') AS month, count(*) AS n, count(DISTINCT user_id) AS clients, true AS clients_in_bound,
  true AS median_in_bound, true AS p90_in_bound FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def t13_sketch_months(spark, sf):
    """Distinct clients and visit length quantiles per month, merged from
    stored daily sketches, each held against the exact figure: whether it lies
    within the sketches' stated error."""
    from visitwise.operators.ranking import materialize
    e = (D.table(spark, sf, "events").where("ts is not null")
         .select(F.to_date("ts").alias("day"), "user_id", F.round(F.col("value") * 60).cast("long").alias("seconds")))
    days = materialize(rollups.sketch_states(e, ["day"], "user_id", "seconds"))
    month = F.date_format("day", "yyyyMM").alias("month")
    shares = {"median": 0.5, "p90": 0.9}
    merged = rollups.merged_sketches(days.select("*", month), ["month"], shares)
    exact = (e.select(month, "user_id", "seconds").join(merged.select("month", *shares), "month")
             .groupBy("month").agg(F.countDistinct("user_id").alias("clients"), F.count("seconds").alias("_n"),
                                   *[F.count_if(F.col("seconds") < F.col(s)).alias(f"_below_{s}") for s in shares],
                                   *[F.count_if(F.col("seconds") <= F.col(s)).alias(f"_to_{s}") for s in shares]))
    near = F.abs(F.col("distinct_estimate") - F.col("clients")) <= F.greatest(F.lit(1.0), rollups.DISTINCT_ERROR * F.col("clients"))
    return merged.join(exact, "month").select(
        "month", "n", "clients", near.alias("clients_in_bound"),
        *[rollups.rank_in_bound(F.col(f"_below_{s}"), F.col(f"_to_{s}"), F.col("_n"), share).alias(f"{s}_in_bound")
          for s, share in shares.items()])


# --------------------------------------------------------- multisets, snapshots

def _halves(spark, sf):
    e = D.table(spark, sf, "events")
    first = F.dayofmonth("ts") <= 15
    return [e.where(f).select("user_id", "event_type") for f in (first, ~first)]


def _halves_sql(op: str) -> str:
    half = "SELECT user_id, event_type FROM events WHERE dayofmonth(ts) {} 15"
    return f"{half.format('<=')} {op} {half.format('>')}"


@register("t14_intersect_all", _halves_sql("INTERSECT ALL"))
def t14_intersect_all(spark, sf):
    """(client, kind) of the first half of the month, as often as the second half has them, too."""
    return setops.intersect_all(*_halves(spark, sf))


@register("t15_except_all", _halves_sql("EXCEPT ALL"))
def t15_except_all(spark, sf):
    """(client, kind) of the first half of the month, as often as the second half lacks them."""
    return setops.except_all(*_halves(spark, sf))


SNAPSHOTS = ("1999-01-01", "2000-01-01")


def active_clients(spark, sf, as_of: str) -> DataFrame:
    """The extract of clients who ordered in the year before ``as_of``."""
    at = F.lit(as_of).cast("timestamp_ntz")
    return (D.table(spark, sf, "orders")
            .where((F.col("o_orderdate") < at) & (F.col("o_orderdate") >= at - F.make_ym_interval(F.lit(1))))
            .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")))


def _active_sql(as_of: str) -> str:
    return (f"(SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders WHERE o_orderdate < TIMESTAMP '{as_of}' "
            f"AND o_orderdate >= TIMESTAMP '{as_of}' - INTERVAL 1 YEAR GROUP BY 1)")


@register("t16_snapshot_diff", f"""
WITH a AS {_active_sql(SNAPSHOTS[0])}, b AS {_active_sql(SNAPSHOTS[1])},
  gone AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b), came AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
SELECT g.*, CASE WHEN o_custkey IN (SELECT o_custkey FROM b) THEN 'update_before' ELSE 'delete' END AS change, CAST(1 AS BIGINT) AS copies FROM gone g
UNION ALL SELECT c.*, CASE WHEN o_custkey IN (SELECT o_custkey FROM a) THEN 'update_after' ELSE 'insert' END, 1 FROM came c""")
def t16_snapshot_diff(spark, sf):
    """What changed between two yearly extracts of active clients."""
    return setops.snapshot_diff(*[active_clients(spark, sf, d) for d in SNAPSHOTS], ["o_custkey"])


# ------------------------------------------------------------ catalogued tables

BUCKETS = 16


@register("t17_bucketed_join", R.ORACLE["j02_visit_left"])
def t17_bucketed_join(spark, sf):
    """J02 on catalogued tables bucketed by client: joined without a shuffle."""
    import uuid

    from visitwise.plans.route import visit_facts
    from visitwise.session import ensure_checkpoint_dir
    from visitwise.sources.catalog import save_table
    folder = f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
    tables = [save_table(df, f"visitwise_{name}", f"{folder}/{name}", bucket_by=["ID_TERCERO"], buckets=BUCKETS)
              for name, df in (("visits", R.visits(spark, sf)), ("clients", R.clients(spark, sf)))]
    return R._round(visit_facts(*tables, null_safe=False), "Distancia_Haversine")


# ------------------------------------------------------------------ variants

_ATTRIBUTES = {"longitude": ("$.901", "string"), "size": ("$.902", "int"), "kind": ("$.0", "string")}


@register("t18_variants", f"""
SELECT entity, max(value) FILTER (WHERE attr_id = 901) AS longitude, TRY_CAST(max(value) FILTER (WHERE attr_id = 902) AS INTEGER) AS size,
  max(value) FILTER (WHERE attr_id = 0) AS kind,
  coalesce(string_agg(attr_id || '=' || value, ',' ORDER BY CAST(attr_id AS VARCHAR)) FILTER (WHERE attr_id NOT IN (901, 902, 0)), '') AS others
FROM {R._EAV_SQL} e GROUP BY entity""")
def t18_variants(spark, sf):
    """EAV rows as one VARIANT an entity: three attributes typed, the undeclared ones kept."""
    from visitwise.operators import variants
    v = variants.entity_variants(R._eav(spark, sf))
    others = F.map_entries(variants.undeclared("attributes", ["901", "902", "0"]))
    text = F.array_join(F.transform(F.sort_array(others), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return v.select("entity", *variants.typed("attributes", _ATTRIBUTES), text.alias("others"))


@register("t19_json_props", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
  min(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_least, count(*) FILTER (WHERE json_extract(props, '$.missing') IS NULL) AS n_missing
FROM events GROUP BY 1""")
def t19_json_props(spark, sf):
    """Typed extraction from the events' JSON properties; texts that are no JSON count as empty."""
    from visitwise.operators import variants
    e = D.table(spark, sf, "events").select("event_type", F.try_parse_json("props").alias("p"))
    e = e.select("event_type", *variants.typed("p", {"k": ("$.k", "bigint"), "missing": ("$.missing", "string")}))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_total"), F.min("k").alias("k_least"),
                                       F.count_if(F.col("missing").isNull()).alias("n_missing"))


# ------------------------------------------------ membership, subqueries, views

@register("t20_never_on_due_date", f"""
SELECT ID_TERCERO, COD_DIA_VISITA, COD_FRECUENCIA_VISITA FROM {R.CL} c WHERE NOT EXISTS (
  SELECT 1 FROM {R.VIS} v JOIN {R.CAL} k ON k.FECHAS_VISITA = v.FECHAS_VISITA
  WHERE v.ID_TERCERO = c.ID_TERCERO AND k.COD_DIA_VISITA = c.COD_DIA_VISITA AND k.COD_FRECUENCIA_VISITA = c.COD_FRECUENCIA_VISITA)""")
def t20_never_on_due_date(spark, sf):
    """Clients that no visit reached on a due date of their plan."""
    from visitwise.operators.membership import anti, semi
    from visitwise.plans.compliance import CODE_KEYS
    cl = R.clients(spark, sf).select("ID_TERCERO", *CODE_KEYS)
    coded = R.visits(spark, sf).select("ID_TERCERO", "FECHAS_VISITA").join(cl, "ID_TERCERO")
    on_due = semi(coded, R.calendar(spark, sf), [*CODE_KEYS, "FECHAS_VISITA"])
    return anti(cl, on_due, ["ID_TERCERO", *CODE_KEYS])


@register("t21_not_in", f"""
SELECT CAST(user_id AS VARCHAR) || '-001' AS ID_TERCERO, event_id FROM events
WHERE CAST(user_id AS VARCHAR) || '-001' NOT IN (SELECT ID_TERCERO FROM {R.CL} c)
  AND lpad(CAST(user_id % 8 AS VARCHAR), 3, '0') NOT IN (SELECT COD_FRECUENCIA_VISITA FROM {R.CL} c WHERE COD_FRECUENCIA_VISITA IS NOT NULL)""")
def t21_not_in(spark, sf):
    """Visits to unknown clients whose code no client has, by ``NOT IN`` twice."""
    from visitwise.operators.membership import not_in
    cl = R.clients(spark, sf)
    e = D.table(spark, sf, "events").select(F.concat(F.col("user_id").cast("string"), F.lit("-001")).alias("ID_TERCERO"), "event_id",
                                            F.lpad((F.col("user_id") % 8).cast("string"), 3, "0").alias("code"))
    codes = cl.where("COD_FRECUENCIA_VISITA is not null")
    return not_in(not_in(e, cl, "ID_TERCERO", "ID_TERCERO"), codes, "code", "COD_FRECUENCIA_VISITA").drop("code")


@register("t22_not_in_with_nulls", f"""
SELECT event_id FROM events WHERE lpad(CAST(user_id % 8 AS VARCHAR), 3, '0') NOT IN (SELECT COD_FRECUENCIA_VISITA FROM {R.CL} c)""")
def t22_not_in_with_nulls(spark, sf):
    """The same against a list with nulls: nothing is known to be absent from it."""
    from visitwise.operators.membership import not_in
    e = D.table(spark, sf, "events").select("event_id", F.lpad((F.col("user_id") % 8).cast("string"), 3, "0").alias("code"))
    return not_in(e, R.clients(spark, sf), "code", "COD_FRECUENCIA_VISITA").drop("code")


_SECONDS_SQL = "CAST(floor((epoch_us(Finalizacion_Visita) - epoch_us(Inicio_Visita)) / 1000000.0) AS BIGINT)"


@register("t23_sql_surface", f"""
WITH v AS (SELECT *, {_SECONDS_SQL} AS seconds FROM {R.VIS} v)
SELECT c.ID_TERCERO, c.COD_CANAL, (SELECT max(Inicio_Visita) FROM v WHERE v.ID_TERCERO = c.ID_TERCERO) AS last_visit,
  (SELECT count(*) FROM v WHERE v.ID_TERCERO = c.ID_TERCERO AND v.seconds > (SELECT avg(seconds) FROM v)) AS long_visits,
  (SELECT max(strftime(FECHAS_VISITA, '%Y%m')) FROM v WHERE v.ID_TERCERO = c.ID_TERCERO) AS last_period
FROM {R.CL} c WHERE EXISTS (SELECT 1 FROM v WHERE v.ID_TERCERO = c.ID_TERCERO AND v.seconds IS NOT NULL)""")
def t23_sql_surface(spark, sf):
    """The same question in SQL over the views, with a CTE, scalar and
    correlated subqueries and the library's SQL functions."""
    from visitwise.plans.views import create_views
    return create_views(R.clients(spark, sf), R.calendar(spark, sf), R.visits(spark, sf)).sql("""
WITH timed AS (SELECT ID_TERCERO, FECHAS_VISITA, Inicio_Visita, visit_seconds(Inicio_Visita, Finalizacion_Visita) AS seconds FROM visits)
SELECT c.ID_TERCERO, c.COD_CANAL, (SELECT max(t.Inicio_Visita) FROM timed t WHERE t.ID_TERCERO = c.ID_TERCERO) AS last_visit,
  (SELECT count(*) FROM timed t WHERE t.ID_TERCERO = c.ID_TERCERO AND t.seconds > (SELECT avg(seconds) FROM timed)) AS long_visits,
  (SELECT max(period_of(t.FECHAS_VISITA)) FROM timed t WHERE t.ID_TERCERO = c.ID_TERCERO) AS last_period
FROM clients c WHERE EXISTS (SELECT 1 FROM timed t WHERE t.ID_TERCERO = c.ID_TERCERO AND t.seconds IS NOT NULL)""")
