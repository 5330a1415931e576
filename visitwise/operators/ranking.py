"""Ranks, buckets, sorts (W01-W03, O01-O03, A04) that survive skew.

A plain ``rank().over(Window.partitionBy(g))`` puts one whole group into
one task.  Here a group may hold a third of all rows, so ranks are computed
in three steps, none of which needs a whole group in one task:

1. histogram of distinct ``(group, value)`` with their row counts - a
   partial (map-side) aggregation, so repeated values collapse before the
   shuffle;
2. the histogram is range-partitioned on ``(group, value)``: a hot group
   spreads over several partitions; local ranks and the per
   ``(partition, group)`` totals come from one window stage and are written
   to the checkpoint folder (partition ids are data from then on, identical
   for every consumer), and the groups that cross a partition boundary
   (at most two per partition, so at most ``2 x partitions`` rows - a
   proven bound, safe to broadcast) get offsets;
3. the ranks are joined back on ``(group, value)``; a hot key there is
   split by adaptive skew-join handling (one histogram row per key).  Several
   ranks of one frame share steps 1-2 (values stacked with a metric tag) and
   reach the wide rows through one join on a row id.

Exact positions in a global order (``global_index``) use the same idea:
range-sorted data, per-partition row counts (one row per partition),
offsets.  The sorted, id-tagged data is checkpointed to the shared
checkpoint folder first, so partition ids and row ids cannot change if a
task is re-run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitwise.session import ensure_checkpoint_dir

_UNB = Window.unboundedPreceding


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def order_col(name: str, ascending: bool = True) -> Column:
    """Sort key with nulls last in both directions (pandas default)."""
    c = F.col(name)
    return c.asc_nulls_last() if ascending else c.desc_nulls_last()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used where one large intermediate feeds several consumers: it is
    computed once, the plan above it stays small, and a lost executor
    re-reads the checkpoint instead of re-running the lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _stack(df: DataFrame, keys: list[str], specs, row_id: str | None = None) -> DataFrame:
    """One row per value to rank, from one pass over ``df``: rows with a null
    key and null or NaN values are left out."""
    types = dict(df.dtypes)
    cells = []
    for i, (value, _, method, desc) in enumerate(specs):
        if method not in ("dense", "min"):
            raise ValueError(method)
        if types[value] not in ("double", "float", "int", "smallint", "tinyint"):
            raise TypeError(f"{value}: stacked ranks need values exact as double")
        v = F.col(value).cast("double")
        cells.append(F.struct(F.lit(i).alias("_metric"), v.alias("_v"), (-v if desc else v).alias("_s")))
    own = ([row_id] if row_id else []) + list(keys)
    return (df.where(_all([F.col(k).isNotNull() for k in keys]))
            .select(*own, F.explode(F.array(*cells)).alias("_c")).select(*own, "_c.*")
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))


def ranks_stacked(df: DataFrame, keys, specs) -> DataFrame:
    """Several ranks over the same groups in one pipeline.

    ``specs``: ``(value, out, method, descending)`` tuples; ``method`` is
    ``dense`` (W01) or ``min`` (W02, competition rank: ties share the
    lowest rank).  Null keys and null/NaN values are left out, so they get
    no rank and do not shift the others.

    The values of all specs are stacked as ``(keys, _metric, _v)`` so that
    one histogram, one range partitioning and one window pass serve them
    all.  Returns distinct ``(keys, _metric, _v)`` with the rank in ``_r``.
    """
    keys = list(keys)
    stacked = _stack(df, keys, specs)
    hist = stacked.groupBy(*keys, "_metric", "_v", "_s").agg(F.count(F.lit(1)).alias("_n"))
    gk = [*keys, "_metric"]
    # partition count from the session (spark.sql.shuffle.partitions), left
    # to adaptive coalescing: merged partitions stay contiguous ranges
    ranged = (hist.repartitionByRange(*[F.col(k) for k in gk], F.col("_s"))
              .withColumn("_pid", F.spark_partition_id()))
    w_local = Window.partitionBy("_pid", *gk).orderBy("_s")
    w_part = Window.partitionBy("_pid", *gk)
    # local ranks and the (partition, group) totals in one window stage;
    # written once: the partition ids must be the same for every consumer
    # below (a re-run range sampling could draw other bounds)
    local = materialize(ranged
                        .withColumn("_ld", F.row_number().over(w_local))
                        .withColumn("_lc", F.coalesce(
                            F.sum("_n").over(w_local.rowsBetween(_UNB, -1)), F.lit(0)))
                        .withColumn("_sd", F.count(F.lit(1)).over(w_part))
                        .withColumn("_sc", F.sum("_n").over(w_part)))
    # one row per (group, partition): the last local row carries the totals
    span = local.where(F.col("_ld") == F.col("_sd")).select(*gk, "_pid", "_sd", "_sc")
    w_g = Window.partitionBy(*gk)
    w_go = w_g.orderBy("_pid").rowsBetween(_UNB, -1)
    offsets = (span.withColumn("_np", F.count(F.lit(1)).over(w_g))
               .where(F.col("_np") > 1)
               .select(*gk, "_pid",
                       F.coalesce(F.sum("_sd").over(w_go), F.lit(0)).alias("_od"),
                       F.coalesce(F.sum("_sc").over(w_go), F.lit(0)).alias("_oc")))
    # offsets: at most two rows per range partition (see module doc)
    ranked = local.join(F.broadcast(offsets), [*gk, "_pid"], "left")
    dense = F.col("_ld") + F.coalesce(F.col("_od"), F.lit(0))
    mini = F.col("_lc") + F.coalesce(F.col("_oc"), F.lit(0)) + 1
    r = None
    for i, (_, _, method, _) in enumerate(specs):
        e = dense if method == "dense" else mini
        r = F.when(F.col("_metric") == i, e) if r is None else r.when(F.col("_metric") == i, e)
    return ranked.select(*gk, "_v", r.cast("int").alias("_r"))


def rank_tables(df: DataFrame, keys, specs) -> list[DataFrame]:
    """One table per spec (see :func:`ranks_stacked`): distinct
    ``(keys, value)`` with the rank in the spec's ``out`` column."""
    keys = list(keys)
    types = dict(df.dtypes)
    st = ranks_stacked(df, keys, specs)
    return [st.where(F.col("_metric") == i)
            .select(*keys, F.col("_v").cast(types[value]).alias(value), F.col("_r").alias(name))
            for i, (value, name, _, _) in enumerate(specs)]


def attach_stacked_ranks(df: DataFrame, row_id: str, keys, specs, store: bool = False) -> DataFrame:
    """All ranks of ``specs`` as new columns of a frame with a unique
    ``row_id``: the stacked ``(row id, keys, metric, value)`` rows look their
    rank up in one join, a pivot by row id turns them into columns, and the
    wide rows meet them in one join on the row id (shuffled once). Row id,
    keys and values are written once as a narrow frame, so the wide frame is
    read twice in all: for the narrow one and for the join. ``store`` writes the
    ranks by row id, too, for a caller who reads the result more than once."""
    keys = list(keys)
    values = [v for v in dict.fromkeys(value for value, *_ in specs) if v not in keys]
    narrow = materialize(df.select(row_id, *keys, *values))
    ranks = ranks_stacked(narrow, keys, specs)
    rows = _stack(narrow, keys, specs, row_id).drop("_s")
    looked = rows.join(ranks, [*keys, "_metric", "_v"], "inner")
    piv = looked.groupBy(row_id).agg(*[
        F.max(F.when(F.col("_metric") == i, F.col("_r"))).alias(name)
        for i, (_, name, _, _) in enumerate(specs)])
    return df.join(materialize(piv) if store else piv, row_id, "left")


def rank_table(df: DataFrame, keys, value: str, out: str,
               method: str = "dense", descending: bool = True) -> DataFrame:
    """One rank (see :func:`rank_tables`)."""
    return rank_tables(df, keys, [(value, out, method, descending)])[0]


def grouped_rank(df: DataFrame, keys, value: str, out: str,
                 method: str = "dense", descending: bool = True) -> DataFrame:
    """``df.groupby(keys)[value].rank(method, ascending=not descending)``
    as a new integer column ``out`` (null where pandas gives NaN)."""
    keys = list(keys)
    return join_ranks(df, [(rank_table(df, keys, value, out, method, descending),
                            keys + [value])])


def join_ranks(df: DataFrame, tables) -> DataFrame:
    """Attach rank tables (``(table, on_columns)`` pairs) to ``df``."""
    for ranks, on in tables:
        df = _join_back(df, ranks, list(on))
    return df


def _join_back(df: DataFrame, ranks: DataFrame, on: list[str]) -> DataFrame:
    a = df.alias("_d")
    b = ranks.alias("_k")
    cond = _all([F.col(f"_d.`{c}`") == F.col(f"_k.`{c}`") for c in on])
    extra = [c for c in ranks.columns if c not in on]
    return a.join(b, cond, "left").select("_d.*", *[F.col(f"_k.`{c}`") for c in extra])


def global_index(df: DataFrame, order: list[Column], out: str = "_row", row_id: str | None = None) -> DataFrame:
    """Exact 0-based position of every row in ``order`` (a total order is
    the caller's duty: add tie-breaks).  Adds ``out`` and ``_nrows``.

    With ``row_id``, a unique column that is fixed in the stored rows, only it
    and the order's columns are sorted and written, ties go by it, and the wide
    rows meet their positions in one join."""
    ensure_checkpoint_dir(df.sparkSession)
    if row_id:
        tagged = df.orderBy(*order, F.col(row_id)).select(row_id, F.monotonically_increasing_id().alias("_mid"))
    else:
        tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a bounded single-task window
    w = Window.orderBy("_pid")
    offs = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(_UNB, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_nrows"))
    res = (tagged.withColumn("_pid", pid)
           .join(F.broadcast(offs), "_pid")
           .withColumn(out, F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
           .drop("_pid", "_off", "_mid"))
    return df.join(res, row_id) if row_id else res


def bucket_of(row: Column, nrows: Column, n: int) -> Column:
    """W03 arithmetic: 1-based bucket of 0-based position ``row`` among
    ``nrows`` rows split into ``n`` contiguous parts, the first
    ``nrows mod n`` parts one row longer (``ntile`` semantics)."""
    q = F.floor(nrows / n)
    r = nrows - q * n
    big = r * (q + 1)
    return (F.when(row < big, F.floor(row / (q + 1)))
            .otherwise(r + F.floor((row - big) / F.greatest(q, F.lit(1))))
            + 1).cast("int")


def balanced_buckets(df: DataFrame, order: list[Column], n: int,
                     out: str = "part", row_id: str | None = None) -> DataFrame:
    """Exact ``ntile(n)`` over ``order`` without a single-task window
    (``row_id``: see :func:`global_index`)."""
    idx = global_index(df, order, "_row", row_id)
    return idx.withColumn(out, bucket_of(F.col("_row"), F.col("_nrows"), n))


def head(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order`` (top-k: partial sort per task)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: list[tuple[str, bool]], n: int) -> DataFrame:
    """Last ``n`` rows of a nulls-last ``order`` given as
    ``(column, ascending)`` pairs - the reversed order (nulls first) and
    ``limit(n)``; no driver-side ``tail``."""
    rev = [F.col(c).desc_nulls_first() if asc else F.col(c).asc_nulls_first()
           for c, asc in order]
    return df.orderBy(*rev).limit(n)


def first_per_key(df: DataFrame, keys, order: list[tuple[str, bool]]) -> DataFrame:
    """One row per key - the first in ``order`` (nulls last).

    Written as ``min(struct(order..., rest...))`` per key: an aggregate with
    a map-side partial step, so a hot key never gathers in one task.
    Descending keys must be numeric (negated inside the struct).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    parts = []
    for i, (c, asc) in enumerate(order):
        col = F.col(c)
        parts.append(col.isNull().alias(f"_o{i}n"))
        parts.append((col if asc else -col).alias(f"_o{i}"))
    parts += [F.col(c).alias(c) for c in rest]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m.`{c}`").alias(c) for c in rest])
