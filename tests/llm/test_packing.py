import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitwise.llm.packing import Piece, VectorPacker, WordEncoder, pack_documents, pack_examples, word_tokenizer_path
from visitwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(word_tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, encode, capacity):
    """texts: list of (id, text); every id in one piece, sequences gapless."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = list(np.frombuffer(r["ids"], "<u4"))
        pieces[r["id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], len(ids)))
    assert set(pieces) == {i for i, _ in texts}
    for i, text in texts:
        ids = [x for _, part, _ in sorted(pieces[i], key=lambda p: p[0]) for x in part]
        assert ids == encode(text)
        assert {n for *_, n in pieces[i]} == {len(ids)}
        assert [s for s, *_ in sorted(pieces[i], key=lambda p: p[0])][0] == 0
    waste = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
        waste += 0 if at & (at - 1) == 0 else capacity - at
    return waste


TEXTS = [(1, None), (2, ""), (3, "Hello, world's 12 naïve <|endoftext|> İSTANBUL ΣΑΣ é"), (4, "a\tb\xa0c\x85d e ﻿"),
         (5, "word " * 9000), (6, "don't we'll <|STARTOFTEXT|> $$$%% µ ª ²³ ß"), (7, "\n\n  x\n"), (8, "日本語 テスト ﬁ"),
         (9, "x" * 30_000)]


def test_encoder_equals_the_tokenizer(encode, documents):
    own = WordEncoder(word_tokenizer_path())
    for text in [t or "" for _, t in TEXTS] + list(documents.values()):
        assert list(np.frombuffer(own(text), "<u4")) == encode(text)[:-1]


def test_packing_is_whole_and_tight(spark, make, encode, documents):
    rows = TEXTS + [(100 + i, t) for i, t in documents.items()]
    for kw in ({}, {"max_segments": 3}, {"capacity": 64, "max_loss": 40}):
        out = pack_documents(make(rows), **kw).collect()
        assert check(out, rows, encode, kw.get("capacity", 2048)) == 0
        per = defaultdict(list)
        for r in out:
            per[r["sequence_id"]].append(r["loss_tokens"])
        assert max(map(len, per.values())) <= kw.get("max_segments", 256)
        assert max(map(sum, per.values())) <= kw.get("max_loss", kw.get("capacity", 2048))


def test_repeated_null_and_clashing_rows(spark, make):
    df = make([(1, "a b"), (1, "a b"), (None, "c")])
    for c in ("id", "ids", "body", "start"):
        df = df.withColumn(c, F.lit("x"))
    out = pack_documents(df).collect()
    assert sorted((r["id"] is None, len(r["ids"])) for r in out if r["start"] == 0)[-1][0]
    assert sum(len(r["ids"]) // 4 for r in out) == 3 + 3 + 2
    assert pack_documents(make([]).where("false")).count() == 0


def test_examples_keep_whole_under_three_limits(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        n = int(rng.integers(1, 90))
        rows.append((i, rng.integers(0, 999, n).tolist(), (rng.random(n) < rng.random()).tolist()))
    rows += [(300, [], []), (301, None, None), (302, [5, 6], None), (303, list(range(250)), [True] * 250)]
    df = spark.createDataFrame(rows, "k long, tok array<int>, m array<boolean>").repartition(2)
    out = pack_examples(df, "k", "tok", "m", capacity=100, max_segments=4, max_loss=60).collect()
    per, ids = defaultdict(list), defaultdict(list)
    for r in out:
        per[r["sequence_id"]].append((len(r["ids"]) // 4, r["loss_tokens"]))
        ids[r["id"]].append((r["start"], list(np.frombuffer(r["ids"], "<u4"))))
    for parts in per.values():
        assert sum(n for n, _ in parts) <= 100 and sum(x for _, x in parts) <= 60 and len(parts) <= 4
    for k, tok, m in rows:
        if tok:
            assert [x for _, p in sorted(ids[k]) for x in p] == tok
            if m and len(tok) <= 100 and sum(m) <= 60:
                assert len(ids[k]) == 1
        else:
            assert k not in ids


def test_dot_product_choice():
    packer = VectorPacker(10, 3, 10, cut=False, pool=8)
    for i, n in enumerate((3, 7, 5, 5)):
        assert not list(packer.feed(Piece(i, 0, bytes(4 * n), np.ones(n, bool), n)))
    assert [sorted(len(p) for p in s) for s in packer.finish()] == [[3, 7], [5, 5]]
    with pytest.raises(ValueError):
        VectorPacker(0, 1, 1)


def test_query(spark, sf, documents, encode):
    out = QUERIES["op9_vector_packing"](spark, sf).collect()
    whole = {i: encode(t) for i, t in documents.items()}
    for r in out:
        part = np.array(whole[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in out) == sum(map(len, whole.values()))
