"""Aggregates at several grains from states that are computed once.

Rows are aggregated to the finest grain first; coarser grains (grouping sets,
rollup, cube, months from days) merge those states and never see the rows
again. Grouping sets therefore expand the few rows of the states, not the table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitwise.operators.ranking import materialize


def rollup_sets(dims: list[str]) -> list[list[str]]:
    return [dims[:k] for k in range(len(dims), -1, -1)]


def cube_sets(dims: list[str]) -> list[list[str]]:
    return [list(s) for k in range(len(dims), -1, -1) for s in combinations(dims, k)]


def grain_states(df: DataFrame, dims: list[str], measures: list[str]) -> DataFrame:
    """The finest grain, written once: ``n`` rows, and for each measure
    ``n_``, ``sum_``, ``min_`` and ``max_``. Null dimensions are a value of their own."""
    states = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        states += [F.count(m).alias(f"n_{m}"), F.sum(m).alias(f"sum_{m}"), F.min(m).alias(f"min_{m}"),
                   F.max(m).alias(f"max_{m}")]
    return materialize(df.groupBy(*dims).agg(*states))


def grouping_sets(states: DataFrame, dims: list[str], sets: list[list[str]], measures: list[str]) -> DataFrame:
    """The states merged to each of the sets of ``dims``, with ``grouping_id``
    (a bit per dimension, the first one highest: 1 if it is rolled up), which
    tells a rolled-up dimension from a null one, and ``avg_`` per measure."""
    merged = [F.grouping_id().cast("long").alias("grouping_id"), F.sum("n").alias("n")]
    for m in measures:
        merged += [F.sum(f"n_{m}").alias(f"n_{m}"), F.sum(f"sum_{m}").alias(f"sum_{m}"),
                   F.min(f"min_{m}").alias(f"min_{m}"), F.max(f"max_{m}").alias(f"max_{m}")]
    out = states.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in dims]).agg(*merged)
    return out.withColumns({f"avg_{m}": F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}").cast("double") / F.col(f"n_{m}"))
                            for m in measures})


# ------------------------------------------------------------------ sketches

#: relative error of a distinct count that HLL sketches of 2^12 registers stay within (three deviations of 1.6%)
DISTINCT_ERROR = 0.05
#: error in rank that KLL sketches of k = 200 stay within
RANK_ERROR = 0.03


def sketch_states(df: DataFrame, keys: list[str], distinct_col: str, value_col: str) -> DataFrame:
    """Mergeable states per ``keys``: ``n``, an HLL sketch of the distinct
    values of ``distinct_col`` and a KLL sketch of ``value_col`` (long), both
    binary, so the rows can be stored and merged later to any coarser keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.col(distinct_col)).alias("distinct_sketch"),
                                 F.kll_sketch_agg_bigint(F.col(value_col)).alias("value_sketch"))


def merged_sketches(states: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """``n``, ``distinct_estimate`` and a quantile column for each of ``shares``
    (name -> 0..1), from the stored states; nulls were not sketched."""
    both = states.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("_d"),
                                     F.kll_merge_agg_bigint("value_sketch").alias("_v"))
    filled = F.kll_sketch_get_n_bigint("_v") > 0
    return both.select(*keys, "n", F.hll_sketch_estimate("_d").alias("distinct_estimate"),
                       *[F.when(filled, F.kll_sketch_get_quantile_bigint("_v", F.lit(s))).alias(name) for name, s in shares.items()])


def rank_in_bound(below: Column, up_to: Column, total: Column, share: float, error: float = RANK_ERROR) -> Column:
    """Whether a value with ``below`` smaller values and ``up_to`` values not
    larger, of ``total``, is a ``share`` quantile within ``error`` in rank."""
    return (below <= (share + error) * total) & (up_to >= (share - error) * total)
