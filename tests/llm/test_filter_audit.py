import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitwise.llm import filter_audit as fa

LABEL = "doc_id long, quality int, toxic int"


def test_positional_counts():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 7, 100, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        want = [int(((words >> k) & 1).sum()) for k in range(32)]
        assert fa.positional_counts(words).tolist() == want


def test_survival_words():
    for failed in range(32):
        for subset in range(32):
            assert (int(fa.WORDS[failed]) >> subset & 1) == (failed & subset == 0)


def brute(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = [k for k, t, _ in docs if (t or "") == text and k is not None and i is not None and k < i]
        rows.append((lang or "", i, {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": bool(smaller)}))
    out = {}
    for part in {p for p, *_ in rows}:
        mine = [(i, f) for p, i, f in rows if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[x] for _, f in mine) - len(gone),
                    sum(f[x] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    for (part, order, step), row in out.items():
        x = order[step - 1]
        row.append(sum(r[1] for (p, o, s), r in out.items() if p == part and o[s - 1] == x))
    return out


def got(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in fa.EFFECTS] for r in df.collect()}


def words(n, kinds, tail=""):
    return " ".join(f"w{k % kinds}" for k in range(n)) + tail


DOCS = [(1, words(300, 250), "en"), (2, words(300, 250), "en"), (3, words(300, 250), "de"), (4, None, "en"), (5, "", None),
        (6, words(250, 10), "en"), (7, words(250, 200, " #"), "en"), (8, "AB\x0bCD\tEF \n", "de"), (9, words(199, 199), "en"),
        (10, words(200, 100), "de"), (11, words(200, 99), "de"), (12, words(220, 220, " " + "A" * 400), "en"),
        (None, words(300, 250), "en"), (None, "x", "fr"), (2, words(300, 250), "en"), (13, "é $" * 50_000, "en"),
        (14, words(200, 200, " " + "é" * 997 + "B" * 30), "en")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (6, 0, 1), (7, 1, None), (None, 1, 1), (13, None, 1), (99, 1, 1), (9, 1, 0)]


def tables(spark, docs=DOCS, labels=LABELS):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3),
            spark.createDataFrame(labels, LABEL).repartition(2))


def test_matches_brute_force(spark):
    docs, labels = tables(spark)
    for c in ("id", "body", "part", "digest", "first", "good", "a.b"):
        docs, labels = docs.withColumn(c, F.lit(1)), labels.withColumn(c, F.lit(1))
    assert got(fa.filter_audit(docs, labels)) == brute(DOCS, LABELS)


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert fa.filter_audit(docs.where("false"), labels).count() == 0
    assert got(fa.filter_audit(docs, labels.where("false"))) == brute(DOCS, [])


@pytest.mark.parametrize("held", [1, 5])
def test_many_parts_and_small_buffers(spark, held, monkeypatch):
    docs = [(i, words(150 + i, 200, "#" * (i % 3)), f"p{i % 7}") for i in range(120)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 120, 3)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    batches = fa._survivors  # in this process: limits as the tasks would have them
    monkeypatch.setattr(fa, "HELD_WORDS", held)
    monkeypatch.setattr(fa, "HELD_CLASSES", 3 * held)
    masks = fa.failure_masks(*tables(spark, docs, labels)).select("part", "failed", "good", "toxic").toArrow()
    total = {}
    for b in batches(iter(masks.to_batches(max_chunksize=11))):
        for r in b.to_pylist():
            total[r["part"], r["label"]] = np.add(total.get((r["part"], r["label"]), 0), r["n"])
    want = {(r["part"], r["label"]): list(r["n"]) for r in
            fa.subset_survivors(fa.failure_masks(*tables(spark, docs, labels))).collect()}
    assert {k: v.tolist() for k, v in total.items()} == want
    assert got(fa.filter_audit(*tables(spark, docs, labels))) == brute(docs, labels)
