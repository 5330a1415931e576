"""Semi and anti joins with SQL's null rules.

``NOT IN`` is three-valued: with a null among the listed values nothing is
known to be absent. Spark plans that form as a broadcast of the whole list, or
nested loops; here the list's nulls and its emptiness are one aggregated row,
and the rest is a plain anti join on distinct values, which shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _matched(df: DataFrame, ref: DataFrame, keys: list[str], ref_keys: list[str], null_safe: bool, how: str) -> DataFrame:
    # distinct values, hashed under a key of their own: a hot key of df can be split
    own = [f"_r{i}" for i in range(len(ref_keys))]
    known = ref.select(*[F.col(r).alias(o) for r, o in zip(ref_keys, own)]).distinct()
    known = known.withColumn("_rh", F.xxhash64(*own)).alias("_ref")
    left = df.withColumn("_h", F.xxhash64(*keys))
    same = [F.col(k).eqNullSafe(F.col(o)) if null_safe else F.col(k) == F.col(o) for k, o in zip(keys, own)]
    return left.join(known, reduce(lambda a, b: a & b, same) & (F.col("_h") == F.col("_rh")), how).drop("_h")


def semi(df: DataFrame, ref: DataFrame, keys: list[str], ref_keys: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    """``EXISTS``: the rows whose keys are in ``ref``; null matches null only if ``null_safe``."""
    return _matched(df, ref, keys, ref_keys or keys, null_safe, "left_semi")


def anti(df: DataFrame, ref: DataFrame, keys: list[str], ref_keys: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    """``NOT EXISTS``: the rows whose keys are not in ``ref``; rows with null keys stay unless ``null_safe`` finds them."""
    return _matched(df, ref, keys, ref_keys or keys, null_safe, "left_anti")


def not_in(df: DataFrame, ref: DataFrame, key: str, ref_key: str) -> DataFrame:
    """``key NOT IN (SELECT ref_key FROM ref)``: no row if ``ref`` holds a
    null, every row if ``ref`` is empty, else those whose key is neither null
    nor listed."""
    nulls = ref.agg(F.count_if(F.col(ref_key).isNull()).alias("n")).scalar()
    rows = ref.agg(F.count(F.lit(1)).alias("n")).scalar()
    return anti(df, ref, [key], [ref_key]).where((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))
