import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitwise.llm.exact_dedup import build_directory, exact_duplicates


def brute(rows):
    def norm(t):
        return (t or "").encode().lower()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[norm(t)]), keep is None or i == keep, hashlib.sha256(norm(t)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ROWS = [(1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "x" * 200_000),
        (9, "X" * 200_000), (9, "x" * 200_000), (None, "abc"), (None, "only null"), (10, "abc "), (11, "ab\x00c")]


@pytest.mark.parametrize("key_bits", [64, 3, 1])
def test_groups_also_when_keys_collide(spark, make, key_bits):
    rows = ROWS + [(100 + i, f"text {i % 40}") for i in range(120)]
    assert got(exact_duplicates(make(rows), key_bits=key_bits, capacity=4, max_depth=5)) == brute(rows)


def test_empty_table_and_clashing_columns(spark, make):
    assert exact_duplicates(make(ROWS).where("false")).count() == 0
    df = make(ROWS)
    for c in ("id", "body", "key", "sha", "n", "top", "bucket", "link"):
        df = df.withColumn(c, F.lit(1))
    assert got(exact_duplicates(df)) == brute(ROWS)


def test_directory_splits_overfull_buckets_only():
    counts = np.zeros(16, np.int64)
    counts[:2] = 50
    counts[9] = 3
    d = build_directory(counts, 60)
    assert len(d) == 16 and d[0] != d[1] and len(set(d[8:])) == 1
    assert list(d) == sorted(d)
    assert len(set(build_directory(counts, 1000))) == 1
    # one prefix beyond the capacity at the deepest level stays one bucket
    assert len(build_directory(np.array([9, 0, 0, 0]), 5)) == 4
