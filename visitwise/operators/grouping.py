"""Grouping operators.

Lists are built from pre-aggregated rows: ``(key, value)`` pairs are first
reduced with a map-side partial aggregation, so a list holds one entry per
distinct value (with its multiplicity), never one entry per input row.  A
hot key therefore costs one entry per distinct value, bounded by the
calendar for date lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_runs(df: DataFrame, keys, value: str, out: str, fmt=None) -> DataFrame:
    """Per key, the sorted values with their repeat counts, as text
    ``v1:n1,v2:n2`` (duplicates kept as counts).  Null keys are dropped, as
    a pandas ``groupby`` does."""
    keys = list(keys)
    runs = (df.where(_not_null(keys))
            .groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_v").isNotNull()))
    return (runs.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_runs"),
                 F.sum("_n").alias(f"n_{out}"))
            .select(*keys, F.col(f"n_{out}"),
                    F.array_join(F.transform("_runs", lambda r: F.concat(
                        _fmt(r["_v"], fmt), F.lit(":"), r["_n"].cast("string"))), ",")
                    .alias(out)))


def value_list(df: DataFrame, keys, value: str, out: str) -> DataFrame:
    """A01 as an array: per key every value, duplicates kept, in ascending
    order (nulls dropped). Built from counted runs, so the shuffle carries one
    entry per distinct value; the repeats appear only in the finished cell."""
    keys = list(keys)
    runs = (df.where(_not_null(keys) & F.col(value).isNotNull())
            .groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    return (runs.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_runs"))
            .select(*keys, F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["_v"], r["_n"].cast("int"))))
                    .alias(out)))


def _fmt(c: Column, fmt):
    return fmt(c) if fmt else c.cast("string")


def _not_null(keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def distinct_lists(df: DataFrame, keys, values: dict) -> DataFrame:
    """Per key, the sorted distinct values of several columns as text
    (nulls dropped), from one pass: the columns are stacked as (number, value)
    rows, reduced to distinct ones, and gathered per key.

    ``values``: output name -> (column, format function or None); each gives
    ``n_<output>`` and ``<output>``. Formats must keep the values' order.
    """
    keys = list(keys)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), _fmt(F.col(c), fmt).alias("v"))
                      for i, (c, fmt) in enumerate(values.values())])
    d = (df.where(_not_null(keys)).select(*keys, F.explode(cells).alias("_c"))
         .select(*keys, "_c.i", "_c.v").where(F.col("v").isNotNull()).distinct())
    lists = d.groupBy(*keys).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("i") == i, F.col("v")))).alias(f"_l{i}")
        for i in range(len(values))])
    out = []
    for i, name in enumerate(values):
        out += [F.size(f"_l{i}").cast("long").alias(f"n_{name}"), F.array_join(f"_l{i}", ",").alias(name)]
    return lists.select(*keys, *out)


def distinct_list(df: DataFrame, keys, value: str, out: str, fmt=None) -> DataFrame:
    """Per key, the sorted distinct values as text (nulls dropped)."""
    return distinct_lists(df.where(F.col(value).isNotNull()), keys, {out: (value, fmt)})


def first_value(df: DataFrame, keys, value: str, order: list[str], out: str) -> DataFrame:
    """Per key, ``value`` of the first row in ``order`` (ties broken by
    the value itself) - an aggregate, so no group is gathered in one task."""
    keys = list(keys)
    ordk = F.struct(*[F.col(c) for c in order], F.col(value))
    return (df.where(_not_null(keys))
            .groupBy(*keys).agg(F.min_by(F.col(value), ordk).alias(out)))


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def profile(df: DataFrame) -> DataFrame:
    """One row per column - name, Spark type, non-null count - from one
    aggregate pass."""
    cols = df.columns
    agg = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', '{t}', _c{i}" for i, (c, t) in enumerate(df.dtypes))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, data_type, non_null)")
