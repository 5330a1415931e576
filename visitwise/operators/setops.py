"""Multiset operations and snapshot differences by signed counts.

Both inputs go through one aggregate: a row counts +1 on the left and -1 on the
right, grouped by all columns (nulls are equal there). Copies of a row collapse
before the shuffle, so a row that makes up a third of a table is one row a
task; it is repeated again only in the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows with their numbers in ``_l`` and ``_r``."""
    if len(left.columns) != len(right.columns):
        raise ValueError("both sides need the same columns")
    both = (left.withColumns({"_l": F.lit(1).cast("long"), "_r": F.lit(0).cast("long")})
            .union(right.withColumns({"_l": F.lit(0).cast("long"), "_r": F.lit(1).cast("long")})))
    return both.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def _repeated(rows: DataFrame, times) -> DataFrame:
    own = [F.col(f"`{c}`") for c in rows.columns if c not in ("_l", "_r")]
    return rows.withColumn("_t", times).where("_t > 0").select(*own, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_t"))).alias("_t")).drop("_t")


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row as often as both sides have it."""
    return _repeated(_counted(left, right), F.least("_l", "_r"))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row as often as the left side has it more than the right side."""
    return _repeated(_counted(left, right), F.col("_l") - F.col("_r"))


def union_max(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row as often as the side that has it more often."""
    return _repeated(_counted(left, right), F.greatest("_l", "_r"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What changed between two extracts of one table: every row that only one
    of them has (or has more often), with ``change``: ``insert`` (a key that
    only the new one has), ``delete`` (only the old one), or ``update_before``
    and ``update_after`` (a key that both have), and ``copies``, how many.

    The keys decide insert from update only; duplicate and null keys are kept
    as they are, counted like any other row.
    """
    signed = _counted(old, new).withColumn("copies", F.col("_r") - F.col("_l")).where("copies <> 0").drop("_l", "_r")
    # a key is an update if rows of it changed on both sides, or an unchanged row of it stays
    # in both; the latter is read from the key counts
    k_old = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(1).alias("_o"), F.lit(0).alias("_n"))
    k_new = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(0).alias("_o"), F.lit(1).alias("_n"))
    names = [f"_k{i}" for i in range(len(keys))]
    known = k_old.union(k_new).groupBy(*names).agg(F.max("_o").alias("_o"), F.max("_n").alias("_n"))
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    out = signed.join(known, cond)
    change = (F.when((F.col("_o") == 1) & (F.col("_n") == 1), F.when(F.col("copies") > 0, "update_after").otherwise("update_before"))
              .when(F.col("copies") > 0, "insert").otherwise("delete"))
    return out.select(*[F.col(f"`{c}`") for c in old.columns], change.alias("change"), F.abs("copies").alias("copies"))


def apply_changes(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The new extract from the old one and :func:`snapshot_diff`'s rows."""
    sign = F.when(F.col("change").isin("insert", "update_after"), F.col("copies")).otherwise(-F.col("copies"))
    moved = changes.select(*[F.col(f"`{c}`") for c in old.columns], sign.alias("_l"))
    total = (old.withColumn("_l", F.lit(1).cast("long")).union(moved)
             .groupBy(*[F.col(f"`{c}`") for c in old.columns]).agg(F.sum("_l").alias("_l")))
    return _repeated(total, F.col("_l"))
