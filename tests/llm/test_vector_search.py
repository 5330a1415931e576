import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from visitwise.llm import vector_search
from visitwise.llm.vector_search import Cells, KdTree, _route, quantised, top_k_inner_product


def brute(points, queries, k):
    out = []
    for q, v in sorted(queries.items()):
        scores = {}
        for i, w in points:
            if i != q:
                s = sum(a * b for a, b in zip(v, w))
                scores[i] = max(s, scores.get(i, s))
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, r, i, s) for r, (i, s) in enumerate(best, 1)]
    return out


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "id", "score").collect())


SCHEMA = "vec_id long, vector array<long>"


def test_matches_brute_force_over_shards_and_blocks(spark):
    rng = np.random.default_rng(3)
    points = [(i, [int(x) for x in rng.integers(-9, 10, 6)]) for i in range(400)]
    points += [(1000 + i, [3, 3, 3, 0, 0, 1]) for i in range(200)]  # a third of the rows: one vector
    df = spark.createDataFrame(points, SCHEMA)
    asked = {i: v for i, v in points if i % 20 == 0}
    out = got(top_k_inner_product(df, df.where("vec_id % 20 = 0"), 20, shard_rows=90, query_block=7))
    assert out == brute(points, asked, 20)


def clusters(rng, n, d=8):
    centres = rng.integers(-300, 300, (12, d))
    return centres[rng.integers(0, 12, n)] + rng.integers(-6, 7, (n, d))


def test_clusters_are_searched_in_few_shards(spark, monkeypatch):
    vectors = clusters(np.random.default_rng(5), 1200)
    points = [(i, [int(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(points, SCHEMA)
    kept = {}
    write = vector_search.spill
    monkeypatch.setattr(vector_search, "spill", lambda df, name, *a: kept.setdefault(name, write(df, name, *a)))
    out = got(top_k_inner_product(df, df.where("vec_id % 20 = 0"), 5, shard_rows=40, query_block=16))
    assert out == brute(points, {i: v for i, v in points if i % 20 == 0}, 5)
    shards = kept["celled"].select("cell").distinct().count()
    assert shards >= 16
    assert kept["rest"].count() < 0.3 * shards * 60  # 60 queries


def test_a_cell_is_left_out_only_if_it_cannot_answer():
    rng = np.random.default_rng(9)
    vectors = clusters(rng, 2000)
    cells = Cells(vectors[:500], 4)
    cell = cells.of(vectors)
    numbers = np.unique(cell)
    lo = np.array([vectors[cell == c].min(axis=0) for c in numbers])
    hi = np.array([vectors[cell == c].max(axis=0) for c in numbers])
    queries = vectors[::50]
    scores = queries @ vectors.T
    least = np.sort(scores, axis=1)[:, -6]
    batch = pd.DataFrame({"rep": range(len(queries)), "v": list(queries), "least": least})
    sent = next(_route(numbers, lo, hi, False)(iter([batch])))
    for asked, row, floor in zip(sent["cells"], scores, least):
        assert set(cell[row >= floor]) <= set(asked)


def test_equal_queries_and_an_id_with_several_vectors(spark):
    hot = [(i, [2, 1, 0]) for i in range(0, 600, 2)]  # half of the queries: one vector
    rng = np.random.default_rng(2)
    other = [(i, [int(x) for x in rng.integers(-4, 5, 3)]) for i in range(1, 600, 2)]
    twice = [(i, [3, 3, int(x)]) for i in range(1000, 1040) for x in rng.integers(-2, 3, 3)]
    points = hot + other + twice
    df = spark.createDataFrame(points, SCHEMA).repartition(5)
    asked = [(i, v) for i, v in points if i % 10 == 0 and i < 1000]
    out = got(top_k_inner_product(df, spark.createDataFrame(asked, SCHEMA), 20, shard_rows=50, query_block=8))
    assert out == brute(points, dict(asked), 20)


def test_cells_of_equal_components(spark):
    assert Cells(np.zeros((40, 3), np.int64), 3).of(np.zeros((5, 3), np.int64)).tolist() == [0] * 5
    points = [(i, [0, 0, i % 2]) for i in range(300)]
    df = spark.createDataFrame(points, SCHEMA)
    out = got(top_k_inner_product(df, df.where("vec_id < 9"), 4, shard_rows=3, query_block=2))
    assert out == brute(points, {i: v for i, v in points if i < 9}, 4)


def test_special_rows(spark):
    points = [(0, [1, 2]), (1, [1, 2]), (1, [1, 2]), (2, [5, -1]), (3, None), (4, [1, None]), (None, [1, 1]),
              (5, [2 ** 31, 2 ** 31]), (6, [0, 0]), (7, [1]), (8, []), (9, [-3, 1]), (9, [3, 1])]
    df = spark.createDataFrame(points, SCHEMA).withColumn("id", F.lit("x")).withColumn("v", F.lit(0))
    sound = [(i, v) for i, v in points if i is not None and v is not None and None not in v]
    for k in (1, 3, 20):
        out = got(top_k_inner_product(df, df.where("vec_id in (0, 5, 3)"), k))
        assert out == brute(sound, {0: [1, 2], 5: [2 ** 31] * 2}, k)
    assert top_k_inner_product(df.where("false"), df).count() == 0
    assert top_k_inner_product(df, df.where("false")).count() == 0


def test_quantised(spark):
    rows = [(1, [0.5, -0.01]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [1.0, None])]
    out = quantised(spark.createDataFrame(rows, "vec_id long, vector array<float>"), "vector")
    assert [tuple(r) for r in out.orderBy("vec_id").collect()] == [
        (1, [32, -1]), (2, None), (3, None), (4, None), (5, None)]


def test_tree_bounds_hold():
    rng = np.random.default_rng(1)
    points = rng.integers(-50, 50, (500, 5)).astype(np.float64)
    tree = KdTree(points, np.arange(500), leaf=16)
    queries = rng.integers(-50, 50, (9, 5)).astype(np.float64)
    bound = tree.bounds(queries)
    for node, rows in enumerate(tree.members):
        if rows is not None:
            assert (points[rows] @ queries.T <= bound[:, node]).all()
    assert sorted(np.concatenate([r for r in tree.members if r is not None])) == list(range(500))
