import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from visitwise.llm import quality as q
from visitwise.llm.queries import op10_quality

LABELS = "doc_id long, quality int, toxic int"


def test_word_vectors_sum_all_contexts(make):
    """Against plain loops over every word and its neighbours."""
    texts = ["a b c a", "b, c!", "", None, "d " * 50, "É é_x"]
    got = q.word_vectors(make(list(enumerate(texts))), buckets=64, dimensions=16)
    places, signs = q.index_places(64, 16)
    total = np.zeros((64, 16))
    for t in texts:
        words = q.word_buckets(t or "", 64).tolist()
        for i, w in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    for p, s in zip(places[words[j]], signs):
                        total[w, p] += s
    total = np.sign(total) * np.log1p(np.abs(total))
    length = np.linalg.norm(total, axis=1, keepdims=True)
    assert np.allclose(got, total / np.where(length == 0, 1, length), atol=1e-6)


def test_special_rows(spark, make):
    rng = np.random.default_rng(0)
    good, bad = [f"w{i}" for i in range(30)], ["$$$", "###", "|"]
    rows, labels = [], []
    for i in range(200):
        words = [str(w) for w in rng.choice(good, 40)]
        if i % 2:
            words = [w + str(rng.choice(bad)) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - i % 2, 0))
    extra = [(500, None), (501, ""), (502, " \n"), (503, "w1 " * 60_000), (None, "w1 w2"), (504, "w1"), (504, "w1")]
    df = make(rows + extra)
    for c in ("id", "body", "score", "y", "vector"):
        df = df.withColumn(c, F.lit("x"))
    lab = spark.createDataFrame(labels[:150] + [(None, 1, 0), (3, None, 0), (9999, 0, 0)], LABELS)
    got = q.quality_scores(df, lab).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["id"]: r["score"] for r in got}
    assert all((by[i] >= 0.5) == bool(y) for i, y, _ in labels)
    assert q.quality_scores(df.where("false"), lab).count() == 0
    assert {r["score"] for r in q.quality_scores(df, lab.where("false")).collect()} == {0.5}
    assert {r["score"] for r in q.quality_scores(df, lab.where("quality = 1")).collect()} == {1.0}


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    p = q.Network(x, y, epochs=30)(x)
    assert abs(p.mean() - y.mean()) < 0.05
    for lo in (0.0, 0.25, 0.5, 0.75):
        inside = (p >= lo) & (p < lo + 0.25)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.12


def test_held_out_accuracy(spark, sf):
    base = sf[:-5] + "0.01"
    out = {r["doc_id"]: r for r in op10_quality(spark, base).collect()}
    assert len(out) == duckdb.sql(f"select count(*) from '{base}/documents.parquet'").fetchall()[0][0]
    labels = duckdb.sql(f"select doc_id, quality from '{base}/labels.parquet'").fetchall()
    held = [(out[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r["held_out"] for r, _ in held)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    assert np.mean([r["predicted"] == y for r, y in held]) >= 0.9
    low = [r["score"] for r, y in held if y == 0]
    high = [r["score"] for r, y in held if y == 1]
    assert np.mean([a < b for a in low for b in high]) >= 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
