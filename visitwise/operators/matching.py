"""Skew-safe natural full outer join (J03) and the mark join.

``natural_full_outer(due, facts, keys)`` returns what
``pd.merge(due, facts, how='outer')`` returns when every column of ``due``
is a key (the due list: client columns + due date):

* each fact row once per matching due row (duplicates multiply),
* each due row with no fact row,
* each fact row with no due row.

Instead of a sort-merge full outer join (whose hot keys cannot be split),
it is built from two aggregates and two joins that adaptive execution can
split: the due list collapses to ``(keys, count)`` with a map-side partial
aggregation; facts keep their rows and left-join the counts (a hot fact key
is split by the skew-join rule, the count side has one row per key); due
keys without facts come from an anti join of the two distinct key sets.

The skew rule splits a join only if a shuffle of its own stands under each
side. Grouped on the join keys, the count side would bring the aggregate's
partitioning along instead; so the join has one more key, a hash of the
others, which the aggregate does not know.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cond(l_alias, r_alias, keys):
    return reduce(lambda a, b: a & b,
                  [F.col(f"{l_alias}.`{k}`").eqNullSafe(F.col(f"{r_alias}.`{k}`")) for k in keys])


_DEFAULTS = {"string": "", "date": "1970-01-01", "boolean": False}


def _null_safe_keys(df: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """Null-safe equality as plain equality on two columns per key: the
    value with nulls replaced, and a null flag.  Grouping and joining on
    these columns partition the same way, so a later join reuses the
    partitioning of an earlier aggregate (the ``<=>`` form would shuffle
    again on its own rewritten keys)."""
    types = dict(df.dtypes)
    cols, names = {}, []
    for i, k in enumerate(keys):
        t = types[k]
        if t == "date":
            dflt = F.lit(_DEFAULTS["date"]).cast("date")
        elif t.startswith("timestamp"):
            dflt = F.lit("1970-01-01 00:00:00").cast(t)
        elif t in _DEFAULTS:
            dflt = F.lit(_DEFAULTS[t])
        else:
            dflt = F.lit(0).cast(t)
        cols[f"_k{i}"] = F.coalesce(F.col(k), dflt)
        cols[f"_z{i}"] = F.col(k).isNull()
        names += [f"_k{i}", f"_z{i}"]
    return df.withColumns(cols), names


def natural_full_outer(due: DataFrame, facts: DataFrame, keys,
                       matched_flag: str | None = None, due_mult: str | None = None,
                       fact_mult: str | None = None, due_distinct: bool = False) -> DataFrame:
    """``due_mult`` / ``fact_mult`` name columns holding how many identical
    copies a row stands for (rows of a de-duplicated dimension); the output
    multiplies exactly as the copies would. ``due_distinct``: no two due rows
    share their keys, so they are not grouped (a task's hash table of them
    would hold all rows that the task makes)."""
    keys = list(keys)
    n = F.sum(due_mult) if due_mult else F.count(F.lit(1))
    d0, nk = _null_safe_keys(due, keys)
    f0, _ = _null_safe_keys(facts, keys)
    # due rows are all keys: keep one representative of the key values
    if due_distinct:
        one = F.col(due_mult) if due_mult else F.lit(1)
        due_keys = d0.select(*nk, one.cast("long").alias("_nd"), *keys)
    else:
        due_keys = d0.groupBy(*nk).agg(n.cast("long").alias("_nd"),
                                       *[F.first(k).alias(k) for k in keys])
    fact_keys = f0.select(*nk).distinct()

    own = F.xxhash64(*nk).alias("_h")
    fact_rows = (f0.select("*", own).join(due_keys.select(*nk, "_nd", own), [*nk, "_h"], "left").drop("_h"))
    rep = F.coalesce(F.col("_nd"), F.lit(1))
    if fact_mult:
        rep = rep * F.col(fact_mult)
    fact_rows = fact_rows.withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), rep)))
    if matched_flag:
        fact_rows = fact_rows.withColumn(matched_flag, F.col("_nd").isNotNull())
    fact_rows = fact_rows.drop("_nd", "_rep", *nk, *([fact_mult] if fact_mult else []))

    only_due = due_keys.join(fact_keys, nk, "left_anti")
    only_due = (only_due.withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_nd"))))
                .select(*keys))
    if matched_flag:
        only_due = only_due.withColumn(matched_flag, F.lit(True))
    return fact_rows.unionByName(only_due, allowMissingColumns=True)


def mark_join(df: DataFrame, ref: DataFrame, keys, flag: str,
              ref_keys=None) -> DataFrame:
    """Keep every row of ``df`` and flag whether its key is in ``ref``.

    ``ref`` is reduced to distinct keys first (no fan-out). Grouped by the
    join's keys, it would lend its partitioning to the join; a hash of the keys
    as one more key gives both sides a shuffle of their own, so that a hot key
    of ``df`` can be split (unless the marks are small enough to be broadcast).
    """
    keys = list(keys)
    rk = list(ref_keys or keys)
    marks = ref.select(*[F.col(r).alias(f"_m{i}") for i, r in enumerate(rk)]).distinct() \
        .withColumns({"_hit": F.lit(True), "_mh": F.xxhash64(*[f"_m{i}" for i in range(len(rk))])})
    left = df.withColumn("_h", F.xxhash64(*[F.col(k).cast(marks.schema[f"_m{i}"].dataType) for i, k in enumerate(keys)]))
    cond = reduce(lambda a, b: a & b, [left[k] == marks[f"_m{i}"] for i, k in enumerate(keys)])
    return (left.join(marks, cond & (left["_h"] == marks["_mh"]), "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False)))
            .drop("_hit", "_h", "_mh", *[f"_m{i}" for i in range(len(rk))]))
