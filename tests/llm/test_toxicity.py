import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from visitwise.llm import toxicity as tx
from visitwise.llm.queries import QUERIES, toxicity_labels

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=240):
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        text = [str(w) for w in rng.choice(words, 30)]
        toxic, junk = i % 3 == 0, i % 3 == 1 and i % 2 == 0
        if toxic:
            text[int(rng.integers(30))] = f"VileWord{i % 4}!"
        if junk:
            text += ["junk", "junk"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def test_learns_categories_in_order(spark, make):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "12 !"), (1003, "word1 " * 30_000), (1003, "word1 vileword1"), (None, "vileword2 a"),
             (1004, "word1 " * 20_000 + "vileword3")]
    df = make(rows + extra)
    for c in ("id", "body", "p", "rejected_", "c0", "y0", "term"):
        df = df.withColumn(c, F.lit("x"))
    lab = spark.createDataFrame([x for x in labels if x[0] % 4] + [(None, 1, 1), (5, None, 1), (6, 1, None)], LABELS)
    out = tx.toxicity(df, toxicity_labels(lab), ["junk", "toxic"])
    assert out.columns == [*df.columns, "p_junk", "p_toxic", "p_severe", "rejected"]
    got = out.collect()
    assert len(got) == len(rows) + len(extra)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 1003}
    assert all(by[i]["rejected"] == bool(t) for i, _, t in labels)
    assert all((by[i]["p_junk"] > 0.5) == (q == 0) for i, q, _ in labels)
    assert not any(by[i]["rejected"] for i in (1000, 1001, 1002)) and by[None]["rejected"] and by[1004]["rejected"]
    assert sorted(r["rejected"] for r in got if r["doc_id"] == 1003) == [False, True]
    assert all(0 <= r[c] <= 1 for r in got for c in ("p_junk", "p_toxic", "p_severe"))


def test_without_labels_and_empty(spark, make):
    df = make([(1, "a b"), (2, "c")])
    none = toxicity_labels(spark.createDataFrame([], LABELS))
    assert not any(r["rejected"] for r in tx.toxicity(df, none, ["junk", "toxic"]).collect())
    one = toxicity_labels(spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS))
    assert not any(r["rejected"] for r in tx.toxicity(df, one, ["junk", "toxic"]).collect())
    assert tx.toxicity(df.where("false"), one, ["junk", "toxic"]).count() == 0


def test_later_models_learn_from_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)).astype(np.float32)
    first = x[:, 0] > 0
    chain = tx.Chain(x, np.column_stack([first, first & (x[:, 1] > 0)]).astype(float))
    assert len(chain.models[1].weights) == len(chain.models[0].weights) + 1
    assert abs(chain.models[1].weights[4]) > 0.1  # the first category's probability matters
    p = chain(x)
    assert ((p[:, 0] > 0.5) == first).mean() > 0.95 and p.shape == (300, 2)


def test_query_separates_held_out_labels(spark, sf):
    out = {r["doc_id"]: r for r in QUERIES["op1_toxicity_chain"](spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall()
    wrong = sum(out[i]["rejected"] != (t == 1) for i, t in labels if i in out)
    assert wrong <= 0.05 * len(labels)
    assert all(r["kept"] == (not r["rejected"]) for r in out.values())


@pytest.mark.parametrize("size, found", [("0.01", 0.7), ("0.1", 0.9)])
def test_query_finds_held_out_toxic_texts(spark, sf, size, found):
    """Trained on half of the labels (about 200 and 2,000 rows), the chain judges the other half's texts."""
    big = f"{sf[:-5]}{size}"
    docs = spark.read.parquet(f"{big}/documents.parquet")
    labels = spark.read.parquet(f"{big}/labels.parquet").where("toxic is not null")
    learn = labels.where("doc_id % 2 = 0")
    out = tx.toxicity(docs, toxicity_labels(learn), ["junk", "toxic"]).select("doc_id", "rejected")
    held = {r[0]: r[1] for r in labels.where("doc_id % 2 = 1").select("doc_id", "toxic").collect()}
    got = [(r["rejected"], held[r["doc_id"]]) for r in out.collect() if r["doc_id"] in held]
    toxic, clean = [r for r, t in got if t], [r for r, t in got if not t]
    assert len(toxic) > 10 and sum(toxic) >= found * len(toxic)
    assert sum(clean) <= 0.03 * len(clean)


def test_rare_toxic_rows_are_in_the_sample(spark, make):
    """Five toxic rows among two thousand, a sample of 200: all five are learned from."""
    rng = np.random.default_rng(7)
    words = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(map(str, rng.choice(words, 30))) + (" vileword" if i % 400 == 0 else "")) for i in range(2000)]
    labels = spark.createDataFrame([(i, 1, int(i % 400 == 0)) for i, _ in rows], LABELS)
    new = [(5000, "word1 word2 vileword word3"), (5001, "word1 word2 word3")]
    features, chain = tx.train(make(rows), toxicity_labels(labels), ["junk", "toxic"], "toxic", "doc_id", "text",
                               sample_rows=200)
    p = chain(features.matrix([t for _, t in new]))
    assert "=vileword" in features.place and p[0, 1] > 0.5 > p[1, 1]


def test_columns_named_like_the_new_ones(spark, make):
    rows, labels = corpus(60)
    df = make(rows).withColumn("Rejected", F.lit("x")).withColumn("p_toxic", F.lit(1)).withColumn("a.b", F.lit(2))
    lab = toxicity_labels(spark.createDataFrame(labels, LABELS))
    out = tx.toxicity(df, lab, ["junk", "toxic"])
    assert out.columns == [*make(rows).columns, "a.b", "p_junk", "p_toxic", "p_severe", "rejected"]
    kept = tx.without_toxic(df, lab, ["junk", "toxic"])
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out.collect() if not r["rejected"]}
