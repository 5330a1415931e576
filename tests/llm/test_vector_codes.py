import numpy as np
import pytest
from pyspark.sql import functions as F

from visitwise.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds):
    """Full searches: rows (id, integer vector, label) by id -> (codes, error), codebooks."""
    width = len(rows[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in rows]
    books = [[list(cut[k][p]) for k in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    out = []
    for (i, _, label), c in zip(rows, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, bytes(k for _, k in best), sum(d for d, _ in best)))
    return out, np.array(books)


def integers(rows):
    return [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_matches_full_searches(spark, rounds):
    rng = np.random.default_rng(rounds)
    centre = rng.normal(size=(7, 8))
    rows = [(i, (centre[i % 7] + rng.normal(size=8) * 0.1).tolist(), i % 4 or None) for i in range(300)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(200)]  # a hot vector
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got, books = vc.compress(vc.integer_vectors(df, "vec_id", "embedding", "label"), 4, 16, rounds)
    want, want_books = brute(integers(rows), 4, 16, rounds)
    assert books.tolist() == want_books.tolist()
    rows_got = sorted((r["id"], r["label"], bytes(r["codes"]), r["error"]) for r in got.collect())
    assert [(i, c, e) for i, _, c, e in rows_got] == [(i, c, e) for i, _, c, e in want]
    label_error = {}
    for _, label, _, e in want:
        label_error[label] = label_error.get(label, 0) + e
    assert all(r["label_error"] == label_error[r["label"]] for r in vc.label_errors(got).collect())
    one = next(r for r in got.collect() if r["id"] == 5)
    assert ((vc.decoded(one["codes"], books) - integers(rows)[5][1]) ** 2).sum() == one["error"]


def test_bounds_skip_searches_and_never_change_a_result():
    rng = np.random.default_rng(1)
    centre = rng.integers(-400, 400, (32, 4))
    vectors = centre[rng.integers(0, 32, 3000)] + rng.integers(-90, 91, (3000, 4))
    history = [centre[:32] + rng.integers(-6, 7, (32, 4))]
    codes, bounds, stamps = np.zeros(3000, np.uint8), np.zeros(3000), np.full(3000, vc.NEVER, np.uint8)
    searched = []
    for _ in range(6):
        searched.append(vc.assign(vectors, history, codes, bounds, stamps))
        d = vc._distances(vectors, history[-1])
        assert (codes == d.argmin(1)).all()
        book = history[-1].copy()
        for k in range(32):
            if (codes == k).any():
                book[k] = vectors[codes == k].sum(0) // (codes == k).sum()
        history.append(book)
    assert searched[0] == 3000 and sum(searched[1:]) < 3000
    assert len(np.unique(stamps)) > 1  # bounds of several rounds live side by side


def test_net_displacement_is_tighter_than_drifts():
    a, b = np.zeros((2, 3), np.int64), np.full((2, 3), 9)
    assert vc.moved(a, a).tolist() == [0, 0]  # there and back: no displacement, though two drifts
    assert (vc.moved(a, b) > 15).all()


def test_special_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.5, 1.0], 1), (1, None, 1), (2, [nan, 1.0], 1), (4, [inf, 0.0], None), (5, [None, 1.0], None),
            (None, [0.25, -0.3], None), (6, [0.5, 1.0], None), (6, [0.5, 1.0], None), (7, [-0.001, 0.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("id", "vector", "codes", "of", "a.b"):
        df = df.withColumn(c, F.lit("x"))
    vectors = vc.integer_vectors(df, "vec_id", "embedding", "label")
    got, books = vc.compress(vectors, 2, 64, 2)
    kept = integers([r for r in rows if r[0] not in (1, 2, 4, 5)])
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    want, want_books = brute(kept, 2, 64, 2)
    assert books.tolist() == want_books.tolist()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["id"], r["label"], bytes(r["codes"]), r["error"]) for r in got.collect()), key=key) == want
    empty, none = vc.compress(vectors.where("false"))
    assert vc.label_errors(empty).count() == 0 and none.size == 0
    assert vc.codebooks_sha256(none) == vc.codebooks_sha256(np.zeros(0))


def test_wrong_dimensions_are_errors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0], 1)], SCHEMA)
    vectors = vc.integer_vectors(df, "vec_id", "embedding", "label")
    with pytest.raises(ValueError):
        vc.compress(vectors, parts=3)
    with pytest.raises(ValueError, match="another dimension"):
        vc.compress(vectors, parts=2)
    with pytest.raises(Exception, match="another dimension"):
        vc.compress(vectors, parts=2, entries=1)[0].collect()
