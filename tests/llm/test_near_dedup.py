import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitwise.llm import near_dedup as nd
from visitwise.llm.base import connected_components
from visitwise.llm.queries import QUERIES


def brute(rows, size=5, percent=85):
    """{row position: (n, component)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if same_id and a and sets[j] or both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), None if key is None else min(ids)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def variants(seed, base_words=120, groups=4, each=12):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(base_words)]
        for _ in range(each):
            words = base[:]
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
            rows.append((rng.randrange(10 ** 6), " ".join(words)))
    return rows


def test_links_match_brute_force(spark, make):
    rows = variants(1)
    assert got(nd.near_duplicates(make(rows))) == brute(rows)


@pytest.mark.parametrize("members, shingles", [(3, 10 ** 9), (512, 300)])
def test_blocks_bounded_by_members_and_by_shingles(spark, make, monkeypatch, members, shingles):
    monkeypatch.setattr(nd, "SET_BLOCK", members)
    monkeypatch.setattr(nd, "SET_SHINGLES", shingles)
    pieces, write = {}, nd.spill
    monkeypatch.setattr(nd, "spill", lambda df, name, *a: pieces.setdefault(name, []).append(df) or write(df, name, *a))
    rows = variants(7, groups=2, each=20)
    assert got(nd.near_duplicates(make(rows))) == brute(rows)
    assert "groups" in pieces  # doubtful classes were compared in blocks


def test_chained_links_of_one_group(spark, make):
    """Every copy changes the one before: the ends are no link, the component is one."""
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(30):
        words[i * 9 % 300] = f"new{i}"
        rows.append((100 - i, " ".join(words)))
    out = got(nd.near_duplicates(make(rows)))
    assert out == brute(rows) and {c for _, _, c in out} == {71}


def test_special_rows(spark, make):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "one two three"),
            (7, "É é"), (8, "é é"), (9, "a b c d e f"), (9, "a b c d e f"), (10, "A B C D E F"),
            (None, "a b c d e f"), (11, "word " * 30_000), (12, "word " * 29_000)]
    assert got(nd.near_duplicates(make(rows))) == brute(rows)
    kept = {(r["id"], r["kept"]) for r in nd.near_duplicates(make(rows)).collect()}
    assert (10, False) in kept and (None, True) in kept and (2, True) in kept


def test_rows_of_one_id_tie_their_texts(spark, make):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, a), (2, a), (2, b), (3, b)]
    assert got(nd.near_duplicates(make(rows))) == brute(rows)
    assert {r["component_id"] for r in nd.near_duplicates(make(rows)).collect()} == {1}


def test_empty_table_and_clashing_columns(spark, make):
    assert nd.near_duplicates(make([]).where("false")).count() == 0
    rows = variants(3, groups=1)
    df = make(rows)
    for c in ("id", "body", "rep", "key", "odd", "a", "b", "print"):
        df = df.withColumn(c, F.lit("x"))
    assert got(nd.near_duplicates(df)) == brute(rows)


def test_hot_group_of_copies(spark, make):
    """A third of all rows are copies of one text, another third near copies."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words)) for i in range(200)]
    rng = random.Random(5)
    for i in range(200, 400):
        other = words[:]
        other[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(other)))
    rows += [(i, " ".join(f"q{i}_{j}" for j in range(40))) for i in range(400, 600)]
    out = nd.near_duplicates(make(rows)).collect()
    assert sum(r["kept"] for r in out) == 201
    assert {r["component_id"] for r in out if r["id"] < 400} == {0}


def test_query_on_all_documents(spark, sf, documents):
    out = got(QUERIES["op2_minhash_near_dedup"](spark, sf).select("doc_id", "n_shingles", "component_id"))
    assert out == brute(list(documents.items()))


@pytest.mark.parametrize("size", [30, 150, 600, 5000, 40000])
def test_odd_sketch_estimates_high_similarity(size):
    rng = np.random.default_rng(size)

    def pair(share):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        cut = int(len(a) * (1 - share) / (1 + share))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[cut:]],
                                      rng.integers(0, 2**63, cut).astype(np.uint64) * np.uint64(2)]))
        far = np.bitwise_count(nd.odd_sketch(a, 1024, 2048) ^ nd.odd_sketch(b, 1024, 2048)).sum()
        return far <= nd.sketch_cut(np.array([(len(a) + len(b)) / 2]), 85, 1024, 2048)[0]

    assert all(pair(share) for share in (0.99, 0.9, 0.86) for _ in range(100))
    assert not any(pair(0.6) for _ in range(20)) or size < 100


def test_connected_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for p in pairs for x in p}
    df = spark.createDataFrame(pairs + [(None, 3), (4, None)], "a long, b long").repartition(6)
    for task_edges in (1000, 40):
        out = {r["node"]: r["component"] for r in connected_components(df, task_edges).collect()}
        loops = {a for a, b in pairs if a == b}
        assert all(out[x] == c for x, c in want.items() if x in out)
        assert set(want) - set(out) <= loops
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
