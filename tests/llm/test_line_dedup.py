import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitwise.llm import line_dedup as ld
from visitwise.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row = row, [i]
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def brute(rows, most, min_chars=20):
    """{(id, text): cleaned text} by comparing all lines."""
    order = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(d, n, s) for d in order for n, s in enumerate(d[1].split("\n")) if len(s) >= min_chars]
    texts = sorted({s for *_, s in lines})
    root = {s: s for s in texts}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                root[find(a)] = find(b)
    first = {}
    for d, n, s in lines:
        first.setdefault(find(s), (d, n))
    gone = {(d, n) for d, n, s in lines if first[find(s)] != (d, n)}
    return {d: "\n".join(s for n, s in enumerate(d[1].split("\n")) if (d, n) not in gone) for d in order}


def check(rows, df, most, **kw):
    want = brute(rows, most)
    out = sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in
                  ld.line_dedup(df, distance=most, **kw).collect()), key=str)
    exp = sorted(((i, None, 0) if t is None else (i, want[(i, t)], t.count("\n") - want[(i, t)].count("\n")
                                                  + (want[(i, t)] == "" and t != "" and brute_all(t, want[(i, t)])))
                  for i, t in rows), key=str)
    assert [(a, b) for a, b, _ in out] == [(a, b) for a, b, _ in exp]
    return out


def brute_all(text, left):
    return left == "" and text != ""


def varied(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefg é") for _ in range(rng.randint(18, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(0, 5)):
            s = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(s))
                s[k:k + rng.choice([0, 1])] = rng.choice(["", "x", "yz"])
            out.append("".join(s))
        rows.append((i, "\n".join(out)))
    return rows


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_matches_brute_force(spark, make, most):
    rows = varied(most)
    check(rows, make(rows), most)


def test_blocks_of_a_large_group(spark, make):
    """Many lines of one key: compared in blocks, no link is lost."""
    rng = random.Random(9)
    head = "the same beginning of a long line "
    rows = [(i, head + "".join(rng.choice("abc") for _ in range(6))) for i in range(150)]
    check(rows, make(rows), 1, block=10)


def test_special_rows(spark, make):
    line = "a line of more than twenty characters"
    rows = [(5, None), (4, ""), (3, f"{line}\nshort\nshort"), (2, f"{line}!\n\n{line}"), (1, "short"), (None, line),
            (7, f"{line}\n{line}"), (7, f"{line}\n{line}"), (8, "other words " * 5000 + "\n" + line), (9, "\n\n")]
    df = make(rows)
    for c in ("id", "doc", "n", "h1", "gone", "body", "key"):
        df = df.withColumn(c, F.lit("x"))
    check(rows, df, 1)
    out = ld.line_dedup(df)
    assert out.columns == [*df.columns, "removed_lines"]
    assert ld.line_dedup(df.where("false")).count() == 0
    removed = {r["doc_id"]: r["removed_lines"] for r in out.collect()}
    assert removed[2] == 2 and removed[3] == 1 and removed[7] == 2 and removed[1] == 0 and removed[None] == 0


def test_query_on_all_documents(spark, sf, documents):
    """Every line of every text as registered, against brute force."""
    import hashlib
    out = {r["doc_id"]: r["text_sha256"] for r in QUERIES["op8_line_dedup"](spark, sf).collect()}
    want = brute_by_length(list(documents.items()))
    assert set(out) == set(documents)
    assert {i: hashlib.sha256(t.encode()).hexdigest() for (i, _), t in want.items()} == {
        i: h for i, h in out.items() if documents[i] is not None}


@pytest.mark.parametrize("hot", [2, 8])
def test_hot_keys_are_dealt_by_line(spark, make, hot, monkeypatch):
    """Lines of a hot key leave its bucket, and no link is lost, nor one between a hot and a cold task."""
    rng = random.Random(hot)
    head = "the same beginning of every one of these lines "
    rows = [(i, head + "".join(rng.choice("abc") for _ in range(5))) for i in range(120)]
    rows += [(1000 + i, f"a line of its own, number {i * i}") for i in range(60)]
    monkeypatch.setattr(ld, "HOT_KEY", hot)
    monkeypatch.setattr(ld, "BUCKET_KEYS", 50)
    texts = [(t,) for _, t in rows]
    import pyarrow as pa
    made = list(ld._keys(1, 20, 7)(iter([pa.record_batch([pa.array([t for t, in texts])], names=["body"])])))
    deals = [d for b in made for d in b.column("deal").to_pylist()]
    assert max(deals) > 1 and 0 in deals
    shared = {(k, h) for b in made for r in [b.sort_by([("bucket", "ascending"), ("deal", "ascending")])]
              for out in ld._shared(iter([r])) for k, h in zip(*(c.to_pylist() for c in out.columns))}
    monkeypatch.setattr(ld, "HOT_KEY", 10 ** 9)
    plain = list(ld._keys(1, 20, 7)(iter([pa.record_batch([pa.array([t for t, in texts])], names=["body"])])))
    assert {d for b in plain for d in b.column("deal").to_pylist()} == {0}
    want = {(k, h) for b in plain for r in [b.sort_by([("bucket", "ascending")])]
            for out in ld._shared(iter([r])) for k, h in zip(*(c.to_pylist() for c in out.columns))}
    assert want <= shared  # a hot key needs no proof that one of its lines has it as a segment
    assert {k for k, _ in shared - want} <= {k for k, _ in shared}
    monkeypatch.setattr(ld, "HOT_KEY", hot)
    check(rows, make(rows), 1, block=10)


def test_character_counts_lose_no_pair(monkeypatch):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(25, 80))) for _ in range(6)]
    lines = []
    for _ in range(80):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(s))
            s[k:k + rng.choice([0, 1])] = rng.choice(["", "x", "Q", "yz"])
        lines.append("".join(s))
    import pyarrow as pa
    lines = sorted(set(lines))

    def links(x, blocks):
        rows = [(1, *x, b, h, s) for h, (b, s) in enumerate(zip(blocks, lines))]
        cols = [pa.array(c) for c in zip(*rows)]
        batch = pa.record_batch(cols, names=["key", "x", "y", "block", "h1", "line"])
        got = [set(zip(*(c.to_pylist() for c in out.columns))) for out in ld._links(ld.DISTANCES)(iter([batch]))]
        root = list(range(len(lines)))

        def find(h):
            while root[h] != h:
                h = root[h]
            return h

        for a, b in set().union(*got):
            root[find(a)] = find(b)
        return [find(h) for h in range(len(lines))]

    def classes(roots):
        return {frozenset(h for h, r in enumerate(roots) if r == q) for q in roots}

    for x, blocks in (((0, 0), [0] * len(lines)), ((0, 1), [h % 2 for h in range(len(lines))])):
        counted = classes(links(x, blocks))
        monkeypatch.setattr(ld, "FEW_PAIRS", 10 ** 9)
        assert counted == classes(links(x, blocks)) and len(counted) < len(lines)
        monkeypatch.setattr(ld, "FEW_PAIRS", 64)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=12), st.text("ab", max_size=12), st.integers(0, 4))
def test_edit_within(a, b, most):
    assert ld.edit_within(a, b, most) == (distance(a, b) <= most)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=4, max_size=14), st.lists(st.tuples(st.integers(0, 13), st.sampled_from(["", "x", "xy"])),
                                                        max_size=3), st.integers(0, 3))
def test_lines_within_the_distance_share_a_key(a, edits, most):
    b = a
    for at, put in edits:
        b = b[:at] + put + b[at + 1:]
    if len(b) > most and distance(a, b) <= most:
        long, short = (a, b) if len(a) >= len(b) else (b, a)
        own, probes = ld.segment_keys(long, most)
        assert set(own + probes) & set(ld.segment_keys(short, most)[0])


def test_short_lines_take_part_by_hash(spark, make):
    rows = [(1, "Share\nTweet\n\na line of more than twenty characters"), (2, "Share\nTweets\n\nShare\n}"),
            (3, "}\na line of more than twenty characterS"), (4, None), (5, "\n\n"), (None, "Share")]
    out = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in
           ld.line_dedup(make(rows), exact_chars=1).collect()}
    assert out == {None: ("Share", 0), 1: ("Tweet\n\na line of more than twenty characters", 1), 2: ("Tweets\n\n}", 2),
                   3: ("", 2), 4: (None, 0), 5: ("\n\n", 0)}


def test_query_and_stage_remove_repeated_short_lines(spark, sf, documents):
    import corpus_pipeline as cp
    from visitwise.llm.base import table
    seen, repeated = set(), {}
    for i in sorted(documents, key=lambda i: (i is not None, i or 0)):
        repeated[i] = 0
        for line in (documents[i] or "").split("\n"):
            if 0 < len(line) < 20:
                repeated[i] += line in seen
                seen.add(line)
    assert sum(repeated.values()) > 0
    out = {r["doc_id"]: r["removed_lines"] for r in QUERIES["op8_line_dedup"](spark, sf).collect()}
    assert all(out[i] >= n for i, n in repeated.items())
    after = cp.line_dedup_stage(spark, table(spark, sf, "documents"), sf).select("text").collect()
    short = [s for r in after for s in (r["text"] or "").split("\n") if 0 < len(s) < 20]
    assert sorted(short) == sorted(seen)


def brute_by_length(rows, classes=((20, 1), (40, 2), (60, 3))):
    """{(id, text): cleaned text}: the distance by the shorter line's length, short lines by equality."""
    order = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(d, n, s) for d in order for n, s in enumerate(d[1].split("\n")) if s]
    texts = sorted({s for *_, s in lines}, key=lambda s: (len(s), s))
    root = {s: s for s in texts}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(texts):  # the shorter one first
        most = max([d for least, d in classes if len(a) >= least], default=0)
        for b in texts[i + 1:]:
            if len(b) - len(a) > most:
                break
            if most and ld.edit_within(a, b, most):
                root[find(a)] = find(b)
    first = {}
    for d, n, s in lines:
        first.setdefault(find(s), (d, n))
    gone = {(d, n) for d, n, s in lines if first[find(s)] != (d, n)}
    return {d: "\n".join(s for n, s in enumerate(d[1].split("\n")) if (d, n) not in gone) for d in order}


def test_distance_by_length_matches_brute_force(spark, make):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefg é") for _ in range(n)) for n in (10, 19, 20, 22, 38, 40, 41, 58, 60, 61, 63, 200)]
    rows = []
    for i in range(120):
        out = []
        for _ in range(rng.randint(0, 4)):
            s = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                k = rng.randrange(len(s))
                s[k:k + rng.choice([0, 1])] = rng.choice(["", "x", "y"])
            out.append("".join(s))
        rows.append((i, "\n".join(out)))
    want = brute_by_length(rows)
    for buckets in (1 << 20, 200):  # one bucket, and many
        ld.BUCKET_KEYS, kept = buckets, ld.BUCKET_KEYS
        try:
            out = ld.line_dedup(make(rows), distance=ld.DISTANCES, exact_chars=1).collect()
        finally:
            ld.BUCKET_KEYS = kept
        assert {(r["doc_id"], r["text"]) for r in out} == {(d[0], t) for d, t in want.items()}


def test_query_matches_brute_force_at_its_distance(spark, documents, tmp_path):
    import hashlib

    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = random.Random(5)
    texts = dict(documents)
    for i, text in documents.items():  # copies whose lines have up to 4 edits
        if text and i % 2:
            lines = [list(s) for s in text.split("\n")]
            for s in lines:
                for _ in range(rng.randint(0, 4)):
                    k = rng.randrange(len(s) + 1)
                    s[k:k + rng.choice([0, 1])] = rng.choice(["", "x", "y"])
            texts[10 ** 6 + i] = "\n".join("".join(s) for s in lines)
    pq.write_table(pa.table({"doc_id": pa.array(texts, pa.int64()), "text": list(texts.values())}),
                   tmp_path / "documents.parquet")
    want = brute_by_length(list(texts.items()))
    assert want != brute_by_length(list(texts.items()), ((20, 1),))
    out = {r["doc_id"]: r["text_sha256"] for r in QUERIES["op8_line_dedup"](spark, str(tmp_path)).collect()}
    assert {d[0]: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()} == {
        i: h for i, h in out.items() if texts[i] is not None}


def test_filter_reaches_the_driver_as_words(spark):
    hot = spark.range(300_000).select(F.xxhash64("id").alias("h1")).unionByName(
        spark.createDataFrame([(-1,), (0,), (63,), (64,), (-(1 << 63),)], "h1 long"))
    want = {r[0] % ld.FILTER_SLOTS for r in hot.collect()}
    assert set(ld._filter(hot).nonzero()[0].tolist()) == want
    assert ld._filter_words(hot).count() == len({s // 64 for s in want}) <= ld.FILTER_SLOTS // 64
    assert ld._filter(hot.where("false")).sum() == 0


def test_texts_are_cut_in_slices():
    """The last step hands on what it has cut a slice at a time, however large Spark's batches are."""
    batch = pa.record_batch([pa.array(range(2500)), pa.array(["a\nb\nc"] * 2500), pa.array([None, [1]] * 1250, pa.list_(pa.int32()))],
                            names=["id", "body", "gone"])
    out = list(ld._without(iter([batch])))
    assert max(b.num_rows for b in out) <= 1000
    assert [r for b in out for r in b.to_pylist()] == [{"id": i, "body": "a\nc" if i % 2 else "a\nb\nc"} for i in range(2500)]
