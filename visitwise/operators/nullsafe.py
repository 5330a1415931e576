"""Null-safe merge (the pandas ``merge`` semantics of SURVEY 1.5).

* keys match null with null (``<=>``),
* outer joins coalesce the key columns into one column,
* overlapping non-key columns get suffixes instead of ambiguous names.

Catalyst still plans an equi-join (hash or sort-merge on the
``coalesce``/``isnull`` pair of each key), so nothing is lost at scale.

A full outer join is written as ``left JOIN right (left outer)`` plus the
right rows whose key is not among the distinct left keys (anti join).
Adaptive execution can split a hot key in both of those join types, not in
a sort-merge full outer join; the distinct left keys hold one row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HOW = {"outer": "full", "full": "full", "left": "left", "right": "right",
        "inner": "inner", "left_semi": "left_semi", "left_anti": "left_anti"}


def null_safe_cond(left: DataFrame, right: DataFrame, keys, right_keys=None) -> Column:
    rk = right_keys or keys
    return reduce(lambda a, b: a & b,
                  [left[lk].eqNullSafe(right[r]) for lk, r in zip(keys, rk)])


def merge(left: DataFrame, right: DataFrame, keys, how: str = "inner",
          suffixes=("_x", "_y"), null_safe: bool = True) -> DataFrame:
    """``pd.merge(left, right, on=keys, how=how)`` on Spark.

    Output columns: left columns in order (keys coalesced for outer joins),
    then the right's non-key columns.
    """
    keys = list(keys)
    how = _HOW[how]
    lcols = [c for c in left.columns]
    rcols = [c for c in right.columns if c not in keys]
    l_other = [c for c in lcols if c not in keys]
    overlap = {c.lower() for c in l_other} & {c.lower() for c in rcols}

    if how == "full":
        return _full_merge(left, right, keys, suffixes, null_safe)

    la = left.alias("_l")
    ra = right.alias("_r")
    if null_safe:
        cond = reduce(lambda a, b: a & b,
                      [F.col(f"_l.`{k}`").eqNullSafe(F.col(f"_r.`{k}`")) for k in keys])
    else:
        cond = reduce(lambda a, b: a & b,
                      [F.col(f"_l.`{k}`") == F.col(f"_r.`{k}`") for k in keys])
    j = la.join(ra, cond, how)
    if how in ("left_semi", "left_anti"):
        return j

    out = []
    for c in lcols:
        if c in keys:
            if how == "full":
                out.append(F.coalesce(F.col(f"_l.`{c}`"), F.col(f"_r.`{c}`")).alias(c))
            elif how == "right":
                out.append(F.col(f"_r.`{c}`").alias(c))
            else:
                out.append(F.col(f"_l.`{c}`").alias(c))
        else:
            name = c + suffixes[0] if c.lower() in overlap else c
            out.append(F.col(f"_l.`{c}`").alias(name))
    for c in rcols:
        name = c + suffixes[1] if c.lower() in overlap else c
        out.append(F.col(f"_r.`{c}`").alias(name))
    return j.select(*out)


def _full_merge(left: DataFrame, right: DataFrame, keys, suffixes, null_safe) -> DataFrame:
    matched = merge(left, right, keys, "left", suffixes, null_safe)
    lk = left.select(*keys).distinct()
    la, ra = lk.alias("_lk"), right.alias("_r")
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = reduce(lambda a, b: a & b, [eq(F.col(f"_r.`{k}`"), F.col(f"_lk.`{k}`")) for k in keys])
    only_right = ra.join(la, cond, "left_anti")
    # same output names as the left-join part: right-only columns keep or
    # get the right suffix, left-only columns are null
    cols = []
    rnames = set(right.columns)
    for out_name, src in zip(matched.columns, _full_sources(left, right, keys)):
        side, name = src
        if side == "r" and name in rnames:
            cols.append(F.col(f"`{name}`").alias(out_name))
        else:
            cols.append(F.lit(None).cast(dict(matched.dtypes)[out_name]).alias(out_name))
    return matched.unionByName(only_right.select(*cols))


def _full_sources(left, right, keys):
    """For each output column of a merge: which side and column feeds it
    (keys come from the right side in the right-only rows)."""
    return ([("r", c) if c in keys else ("l", c) for c in left.columns]
            + [("r", c) for c in right.columns if c not in keys])


def common_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """Keys of a natural merge: the common columns, in the left's order."""
    rs = set(right.columns)
    return [c for c in left.columns if c in rs]
