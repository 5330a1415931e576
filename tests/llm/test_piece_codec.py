import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from visitwise.llm import piece_codec as pc
from visitwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pc.piece_model_path())


@pytest.fixture(scope="module")
def codec():
    return pc.PieceCodec(pc.piece_model_path())


TEXTS = ["", " ", "   ", "hello  world", "a\x00b", "ab\n\ncd▁x", "▁", "é ü ﬁ 日本語 テスト", "😀🎉 x", "​﻿", "<0x41><s>",
         "the " * 3000, "x" * 40_000, " lead", "trail ", "\t\r\n", "aaaaaaaaaaaaaaaaab", "1234567890 3.14", "͏ \U0010fffe"]


def test_equals_the_model(codec, model, documents):
    texts = TEXTS + [t for t in documents.values() if t][:80]
    rng = random.Random(3)
    alphabet = "abcdeéß ▁\n0.,日😀th"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    for text, ids in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == model.encode(text), text[:80]
        assert codec.decode(ids) == model.decode(ids.tolist()), text[:80]


def test_edges_are_all_occurrences(codec):
    text = "▁then the▁the"
    start, end, token = codec.edges(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    want = {(i, i + len(n), t) for n, t in codec.id.items() for i in range(len(text)) if text.startswith(n, i)}
    assert set(zip(start.tolist(), end.tolist(), token.tolist())) == want and len(start) == len(want)


def test_small_indexes_and_tables(codec, model, monkeypatch, documents):
    monkeypatch.setattr(pc, "INDEX_CHARS", 50)
    monkeypatch.setattr(pc, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(pc, "PAIR_ENTRIES", 30)
    own = pc.PieceCodec(pc.piece_model_path())
    texts = [t[:600] for t in documents.values() if t][:8]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in own.encode(texts)] == [model.encode(t) for t in texts]


def test_tables(spark, make, model):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é ▁ 😀"), (4, "word " * 20_000)]
    df = make(rows)
    for c in ("id", "ids", "body", "c0"):
        df = df.withColumn(c, F.lit("x"))
    encoded = pc.encode_texts(df)
    got = sorted(((r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in encoded.collect()), key=str)
    assert got == sorted(((i, model.encode(t or "")) for i, t in rows), key=str)
    back = pc.decode_ids(encoded.withColumn("text_", F.lit(1)).withColumn("c1", F.lit(2)))
    assert back.columns == ["id", "text_", "c1", "text"]
    assert sorted(((r["id"], r["text"]) for r in back.collect()), key=str) == sorted(
        ((i, model.decode(model.encode(t or ""))) for i, t in rows), key=str)
    assert pc.encode_texts(df.where("false")).count() == 0
    none = spark.createDataFrame([(1, None)], "id long, ids binary")
    assert [r["text"] for r in pc.decode_ids(none).collect()] == [None]


def test_query_round_trip(spark, sf, documents, model):
    out = {r["doc_id"]: r for r in QUERIES["op4_piece_codec"](spark, sf).collect()}
    assert set(out) == set(documents)
    for i, t in documents.items():
        ids = model.encode(t)
        assert (out[i]["n_ids"], out[i]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert out[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
