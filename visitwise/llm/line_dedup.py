"""Line dedup by a segment-partition edit join.

Lines within ``distance`` edits of one another are one class (links chain);
the first occurrence of a class in the corpus stays, by (id, line number).
Lines too short for the edit join can take part by their hash alone. The
distance is a number or follows the length, in classes; of two lines the shorter
one's counts.

A line is cut into distance + 1 segments; a line within that many edits holds
at least one of them unchanged, at a start that length and segment number
confine to a few places. So every line enters one key for each of its segments
and probes the keys of its own substrings, for its own length and the lengths
up to ``distance`` below. Keys travel packed, 14 bytes each, to buckets of
bounded expected size, where those that only one line has (nearly all) go. A key
that many lines of one task share is hot: its lines are dealt by their own
hashes, and only two of them stand for it in its bucket. The rest are verified
in their key's group by banded bit-parallel edit distance, after a comparison
of character counts, which no pair within the distance fails; a group hands on
a spanning forest of its links, never its pairs, and a large group is cut into
blocks whose pairs are separate rows of work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import connected_components, quoted, slices, spill, split_join

DISTANCE = 1
DISTANCES = ((20, 1), (40, 2), (60, 3))  # (length from, distance): the registered query and the pipeline's stage
MIN_CHARS = 20           # of the edit join
EXACT_CHARS = 1          # of the exact classes in the registered query and the pipeline's stage
BLOCK = 500              # lines of one key that are compared in one piece of work
FILTER_SLOTS = 1 << 22   # bounds what the driver sees of wanted lines
BUCKET_KEYS = 1 << 20    # keys that are expected in one bucket
HOT_KEY = 64             # lines of one key among a task's _PIECE keys, from which on it is dealt by line
HOT_DEALS = 4096         # ways in which a hot key's lines are dealt at most
FEW_PAIRS = 64           # pairs that are compared without counting characters first
_SEEN = 200_000
_PIECE = 250_000         # keys that a task packs at a time


def edit_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance of ``a`` and ``b`` is at most ``most``.

    What both share at the ends goes first. Over the rest, bit-parallel columns
    hold a band of 2 * most + 1 diagonals in one word: a set bit of ``up``
    (``down``) says that a cell is one more (less) than the cell above it.
    """
    if abs(len(a) - len(b)) > most:
        return False
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    lo, hi = 0, len(b)
    while lo < hi:  # the longest common start, by halving
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(b)
    while lo < hi:  # the longest common end
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid:] == b[len(b) - mid:] else (lo, mid - 1)
    a, b = a[:len(a) - lo], b[:len(b) - lo]
    if not b or most == 0:
        return len(a) <= most
    if most >= len(a):
        return True
    # rows are a's characters; column j sees rows j - most .. j + most, and bit k
    # of a column stands for row j - most + k
    width = 2 * most + 1
    full = (1 << width) - 1
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i + most
    # column 0: the cell of row i is |i|; rows above row 0 only fill the band
    up, down = full << most + 1 & full, (1 << most + 1) - 1
    top, score = 1 << width - 1, most  # of the band's lowest cell: row j + most
    for j, c in enumerate(b, 1):
        same = at.get(c, 0) >> (j - 1) & full  # bit k: a[j - most + k - 1] == c
        # the previous column's bits, moved to this column's rows
        up_, down_ = up >> 1 | top, down >> 1
        diagonal = (((same & up_) + up_) ^ up_ | same | down_) & full
        right = (down_ | ~(diagonal | up_)) & full
        left = diagonal & up_
        score += not diagonal & top
        right = right << 1 | 1
        up = (left << 1 | ~(diagonal | right)) & full
        down = right & diagonal & full
    # from the lowest cell of the last column (row len(b) + most) up to row len(a)
    for k in range(width - 1, len(a) - len(b) + most, -1):
        score += (down >> k & 1) - (up >> k & 1)
    return score <= most


def segments(length: int, distance: int) -> list[tuple[int, int]]:
    """(start, length) of the distance + 1 segments of a line; the last ones
    are one longer where the length does not divide."""
    parts = distance + 1
    short, longer = length // parts, length % parts
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def distance_at(length: int, distance: int | tuple[tuple[int, int], ...]) -> int:
    """The distance of a line of that length; -1 below the first class."""
    if isinstance(distance, int):
        return distance
    return max((d for least, d in distance if length >= least), default=-1)


@lru_cache(1 << 14)
def _places(n: int, distance) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, end, seed) of what a line of ``n`` characters has keys for: its
    segments, and the substrings that a line as long or shorter could hold as one."""
    most = distance_at(n, distance)
    own = [(at, at + size, n << 6 | i) for i, (at, size) in enumerate(segments(n, most))]
    probes = []
    for length in range(max(1, n - most), n + 1):
        shift, d = n - length, distance_at(length, distance)
        if shift > d or length <= d:
            continue
        for i, (at, size) in enumerate(segments(length, d)):
            first = max(0, at - i, at + shift - (d - i))
            last = min(n - size, at + i, at + shift + (d - i))
            probes += [(p, p + size, length << 6 | i) for p in range(first, last + 1)
                       if shift or p != at]  # the own segment has its key already
    return own, probes


def segment_keys(line: str, distance) -> tuple[list[int], list[int]]:
    """Keys of the line's own segments, and of the substrings that a line of
    its length or up to ``distance`` shorter could hold as a segment.

    With i edits before segment i and the rest behind, a match starts within i
    of the segment's place from the left, and within distance - i from the
    right; the places that satisfy both are probed.
    """
    own, probes = _places(len(line), distance)
    key = xxhash.xxh3_64_intdigest
    return [key(line[a:b], seed) for a, b, seed in own], [key(line[a:b], seed) for a, b, seed in probes]


def _hash(line: str) -> tuple[int, int]:
    """128 bits of a line as two signed numbers; the first one is its short name."""
    h = xxhash.xxh3_128_intdigest(line.encode())
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _eligible(text: str | None, min_chars: int) -> Iterator[tuple[int, str]]:
    for n, line in enumerate((text or "").split("\n")):
        if len(line) >= min_chars:
            yield n, line


def _lines(exact_chars: int):
    """mapInArrow: (doc, id, body) -> one row per line of at least ``exact_chars`` with its hash."""
    names = ["doc", "id", "n", "h1", "h2"]
    kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(doc, key, n, *_hash(line)) for doc, key, text in zip(*(c.to_pylist() for c in batch.columns))
                    for n, line in _eligible(text, exact_chars)]
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return run


def _keys(distance, min_chars: int, buckets: int):
    """mapInArrow: body -> (bucket, deal, keys, names, own): the keys of the
    lines of at least ``min_chars`` at a task's first sight of them. A row holds
    keys of a bucket (the low 48 bits) and the short names of their lines; the
    first ``own`` are of segments, the others probes. Deals above 0 hold the
    lines of hot keys, by name; deal 0 has two lines of such a key, by which
    the bucket sees that it is shared."""
    deals = min(buckets, HOT_DEALS)

    def packed(own: list[int], probes: list[int], own_of: list[int], probes_of: list[int]) -> pa.RecordBatch:
        keys, of = np.array(own + probes, np.uint64), np.array(own_of + probes_of, np.int64)
        first, deal = np.arange(len(keys)) < len(own), np.zeros(len(keys), np.int32)
        top = (keys >> np.uint64(48)).astype(np.int64)
        crowded = np.flatnonzero(np.bincount(top, minlength=1 << 16)[top] >= HOT_KEY)
        _, which, size = np.unique(keys[crowded], return_inverse=True, return_counts=True)
        hot = crowded[size[which] >= HOT_KEY]
        if len(hot):
            hot = hot[np.lexsort((of[hot], keys[hot]))]
            start = np.flatnonzero(np.concatenate([[True], keys[hot][1:] != keys[hot][:-1]]))
            ends = np.concatenate([hot[start], hot[np.append(start[1:], len(hot)) - 1]])
            any_own = np.tile(np.logical_or.reduceat(first[hot], start), 2)
            deal[hot] = 1 + of[hot] % deals
            keys, of = np.concatenate([keys, keys[ends]]), np.concatenate([of, of[ends]])
            first, deal = np.concatenate([first, any_own]), np.concatenate([deal, np.zeros(len(ends), np.int32)])
        bucket = (((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((~first, bucket * (HOT_DEALS + 1) + deal))
        place = (bucket * (HOT_DEALS + 1) + deal)[order]
        numbers, cuts = np.unique(place, return_index=True)
        raw, of, first = keys.view(np.uint8).reshape(-1, 8)[order, :6], of[order], first[order]
        spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]))
        return pa.record_batch(
            [pa.array(numbers // (HOT_DEALS + 1)), pa.array((numbers % (HOT_DEALS + 1)).astype(np.int32)),
             pa.array([raw[a:b].tobytes() for a, b in spans], pa.binary()),
             pa.array([of[a:b].tobytes() for a, b in spans], pa.binary()),
             pa.array([int(first[a:b].sum()) for a, b in spans], pa.int32())],
            names=["bucket", "deal", "keys", "names", "own"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: tuple[list[int], ...] = ([], [], [], [])
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for _, line in _eligible(text, min_chars):
                    h1 = _hash(line)[0]
                    if h1 in seen or distance_at(len(line), distance) < 0:
                        continue
                    seen.add(h1)
                    own, probes = segment_keys(line, distance)
                    for to, more in zip(held, (own, probes, [h1] * len(own), [h1] * len(probes))):
                        to += more
                    if len(held[0]) + len(held[1]) >= _PIECE:
                        yield packed(*held)
                        held = ([], [], [], [])
            if len(seen) > _SEEN:
                seen.clear()
        if held[0]:
            yield packed(*held)
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow on the rows of :func:`_keys` in the order of (bucket, deal):
    (key, h1) of the keys that several lines have, one of them as a segment."""
    def found(bucket: int, deal: int, held: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
        names = np.concatenate([np.frombuffer(of, np.int64) for _, of, _ in held])
        raw = np.zeros((len(names), 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(k for k, _, _ in held), np.uint8).reshape(-1, 6)
        own = np.concatenate([np.arange(len(of) // 8) < n for _, of, n in held])
        keys = raw.view(np.uint64).ravel()
        order = np.lexsort((names, keys))
        keys, names, own = keys[order], names[order], own[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(start, len(keys)))
        several = (names[start] != names[start + size - 1]) & np.logical_or.reduceat(own, start)
        first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])])
        at = np.flatnonzero((np.repeat(several, size) | (deal > 0)) & first)
        return pa.record_batch([pa.array((keys[at] ^ np.uint64(bucket % (1 << 16) << 48)).view(np.int64)),
                                pa.array(names[at])], names=["key", "h1"])

    at, held = None, []
    for batch in batches:
        for bucket, deal, keys, names, own in zip(*batch.columns):
            place = (bucket.as_py(), deal.as_py())
            if held and place != at:
                yield found(*at, held)
                held = []
            at = place
            held.append((keys.as_py(), names.as_py(), own.as_py()))
    if held:
        yield found(*at, held)


def _filter_words(hot: DataFrame) -> DataFrame:
    """The slots of the ``h1`` in ``hot`` as (word, bits), 64 slots a row, folded in the tasks."""
    return (hot.select(F.pmod("h1", F.lit(FILTER_SLOTS)).alias("slot"))
            .groupBy(F.expr("shiftright(slot, 6)").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")))


def _filter(hot: DataFrame) -> np.ndarray:
    """Which of the ``FILTER_SLOTS`` slots are set; the driver gets 16 bytes for 64 of them."""
    got = _filter_words(hot).toArrow()
    words = np.zeros(FILTER_SLOTS // 64, np.int64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy()
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def _wanted_lines(slots: np.ndarray, min_chars: int):
    """mapInArrow: body -> (h1, line) of the lines whose slot is set, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                for _, line in _eligible(text, min_chars):
                    h1 = _hash(line)[0]
                    if slots[h1 % len(slots)] and h1 not in seen:
                        seen.add(h1)
                        rows.append((h1, line))
            if len(seen) > _SEEN:
                seen.clear()
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string()))],
                                      names=["h1", "line"])
    return run


def _links(distance):
    """mapInArrow on rows (key, x, y, block, h1, line) in the order of (key, x,
    y): each (key, x, y) is one piece of work, comparing block x with block y.
    Yields a spanning forest of the links found in each piece."""
    def candidates(left: list[str], right: list[str], same: bool) -> Iterator[tuple[int, int]]:
        """Places of the pairs that lengths and character counts allow: an edit
        adds at most one character and takes away at most one."""
        if len(left) * len(right) <= FEW_PAIRS:
            yield from ((i, j) for i in range(len(left)) for j in range(i + 1 if same else 0, len(right)))
            return
        (n, most, counts), (n2, most2, counts2) = profile(left), profile(right)
        for i in range(len(left)):
            lo = i + 1 if same else 0
            room = np.minimum(most[i], most2[lo:]) * 2 - np.abs(n2[lo:] - n[i])
            at = np.flatnonzero(room >= np.abs(n2[lo:] - n[i]))
            near = np.abs(counts2[lo + at] - counts[i]).sum(1) <= room[at]
            yield from ((i, lo + j) for j in at[near].tolist())

    def profile(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(s) for s in lines])
        code = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32) & 31
        counts = np.bincount(np.repeat(np.arange(len(lines)) * 32, n) + code, minlength=32 * len(lines))
        return n, np.array([distance_at(k, distance) for k in n.tolist()]), counts.reshape(-1, 32).astype(np.int32)

    def forest(x: int, y: int, rows: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
        left = [(h, s) for b, h, s in rows if b == x]
        right = left if x == y else [(h, s) for b, h, s in rows if b == y]
        root = {h: h for _, h, _ in rows}

        def find(h: int) -> int:
            while root[h] != h:
                root[h] = h = root[root[h]]
            return h

        out = []
        for i, j in candidates([s for _, s in left], [s for _, s in right], x == y):
            (h, s), (g, t) = left[i], right[j]
            a, b = find(h), find(g)
            if a != b and edit_within(s, t, distance_at(min(len(s), len(t)), distance)):
                root[a] = b
                out.append((h, g))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[tuple[int, int, str]] = []
        for batch in batches:
            found = []
            for key, x, y, block, h1, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, x, y) != at:
                    if at:
                        found += forest(*at[1:], held)
                    at, held = (key, x, y), []
                held.append((block, h1, line))
            yield pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
        if at:
            found = forest(*at[1:], held)
            yield pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: the text (last but one column) without the lines in ``gone`` (the last)."""
    for batch in slices(batches):
        out = []
        body, gone = batch.columns[-2:]
        for text, drop in zip(body, gone):
            if drop.is_valid:
                drop = set(drop.as_py())
                out.append("\n".join(s for n, s in enumerate(text.as_py().split("\n")) if n not in drop))
            else:
                out.append(text.as_py())
        yield pa.record_batch([*batch.columns[:-2], pa.array(out, pa.string())], names=batch.schema.names[:-1])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   distance: int | tuple[tuple[int, int], ...] = DISTANCE, min_chars: int = MIN_CHARS,
                   block: int = BLOCK, exact_chars: int | None = None) -> DataFrame:
    """The lines to remove: (doc, id, n), ``n`` the line number from 0 and
    ``doc`` the hash of (id, text) that :func:`doc_key` gives.

    A line goes when a line of its class (edit distance up to ``distance``,
    links chaining) stands earlier, by (id, doc, n). ``distance`` is a number,
    or pairs (length from, distance), rising, for the shorter line's length. Lines below ``min_chars``
    characters are a class only with their equals, and below ``exact_chars``
    (``min_chars`` if not given) they take no part. Null and empty texts have no
    lines.
    """
    exact_chars = min_chars if exact_chars is None else min(exact_chars, min_chars)
    named = docs.select(doc_key(id_col, text_col).alias("doc"), F.col(f"`{id_col}`").alias("id"),
                        F.col(f"`{text_col}`").alias("body"))
    lines = spill(named.mapInArrow(_lines(exact_chars), "doc long, id long, n int, h1 long, h2 long"), "lines")
    longest = distance if isinstance(distance, int) else distance[-1][1]
    each = sum(map(len, _places(1000 * (longest + 1), distance)))  # keys of a long line
    buckets = max(1, -(-lines.count() * each // BUCKET_KEYS))
    packed = named.select("body").mapInArrow(_keys(distance, min_chars, buckets),
                                             "bucket long, deal int, keys binary, names binary, own int")
    hot = spill(packed.repartition(buckets, "bucket", "deal").sortWithinPartitions("bucket", "deal")
                .mapInArrow(_shared, "key long, h1 long"), "shared")
    # the texts of those lines, by a filter of bounded size and an exact join
    texts = (named.select("body").mapInArrow(_wanted_lines(_filter(hot), min_chars), "h1 long, line string")
             .groupBy("h1").agg(F.min("line").alias("line")))
    blocks = hot.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    work = (split_join(hot, blocks, ["key"]).withColumn("block", F.pmod(F.xxhash64("h1"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "h1")
            .join(texts, "h1").select("key", "x", "y", "block", "h1", "line"))
    links = spill(work.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "h1")
                  .mapInArrow(_links(distance), "a long, b long").distinct(), "links")
    classes = connected_components(links)

    placed = (lines.select("doc", "id", "n", "h1", "h2").join(classes, F.col("h1") == F.col("node"), "left")
              .select("doc", "id", "n", F.coalesce("component", "h1").alias("c1"),
                      F.when(F.col("component").isNull(), F.col("h2")).otherwise(0).alias("c2")))
    placed = spill(placed, "placed")
    first = (placed.groupBy("c1", "c2").agg(F.count("*").alias("c"), F.min(F.struct("id", "doc", "n")).alias("first"))
             .where("c > 1").select("c1", "c2", "first"))
    return (split_join(placed, first, ["c1", "c2"])
            .where(~(F.struct("id", "doc", "n").eqNullSafe(F.col("first")))).select("doc", "id", "n"))


def doc_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               distance: int | tuple[tuple[int, int], ...] = DISTANCE, min_chars: int = MIN_CHARS,
               block: int = BLOCK, exact_chars: int | None = None, count_col: str | None = "removed_lines") -> DataFrame:
    """``docs``, every row, with the lines that :func:`repeated_lines` names
    taken out of the text, and a last column ``count_col`` (long): how many. A
    column of ``docs`` of that name gives way to it; without a name (None) the
    columns are those of ``docs``.

    Lines below ``min_chars`` characters go only if an equal line stands
    earlier, those below ``exact_chars`` (``min_chars`` if not given) and null
    texts always stay. A
    text all of whose lines go becomes empty. Rows that repeat an id and a text
    are one document: their lines go or stay alike. Rows without an id come
    first in the order. Extra columns pass through; an empty table gives an
    empty result.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    gone = (repeated_lines(docs, id_col, text_col, distance, min_chars, block, exact_chars)
            .groupBy("doc", "id").agg(F.collect_set("n").alias("gone")))  # bounded by a document's lines
    key = columns[docs.columns.index(id_col)]
    named = docs.select(doc_key(id_col, text_col).alias("doc"),
                        *[c.alias(own) for c, own in zip(quoted(docs.columns), columns)])
    body = columns[docs.columns.index(text_col)]
    others = [c for c in columns if c != body]
    joined = (named.join(gone, (named["doc"] == gone["doc"]) & named[key].eqNullSafe(gone["id"]), "left")
              .select(*others, F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
                      .alias("removed_lines"),
                      F.col(body), F.col("gone")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    out = joined.mapInArrow(_without, schema)
    kept = [F.col(own).alias(c) for c, own in zip(docs.columns, columns) if c.lower() != (count_col or "").lower()]
    return out.select(*kept, *([F.col("removed_lines").alias(count_col)] if count_col else []))
