"""Exact dedup through an extendible-hash index on shared files.

1. Every text gets its SHA-256; the first ``key_bits`` bits are its key.
2. A directory of key prefixes starts with one bucket. A bucket with more
   distinct keys than its capacity splits on the next bit, and the directory
   doubles when that bucket is as deep as the directory. The counts it needs
   are one bounded histogram of key prefixes.
3. Map tasks collapse equal texts first, so a text that a third of all rows
   hold reaches its owner as one row per task. Owner tasks take whole buckets
   (ranges of the key space), read their rows in key order, chain the different
   texts of one key, comparing bytes, and write the bucket's index file in the
   shared folder.
4. Rows look up their key in the index. Only where a key has more than one
   chain entry are bytes compared again; such keys are the only texts that
   move twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import only, spill

CAPACITY = 20_000  # distinct keys a bucket
MAX_DEPTH = 16     # bounds the directory and the histogram: 2^16 entries; beyond, buckets outgrow
                   # their capacity, which owner tasks stand, as they read rows in key order and hold one chain
KEY_BITS = 64
_LOCAL_BYTES = 32_000_000


def build_directory(counts: np.ndarray, capacity: int) -> np.ndarray:
    """The directory over prefixes of ``log2(len(counts))`` bits: for each
    prefix the first prefix of its bucket. ``counts``: distinct keys by prefix.
    """
    deepest = len(counts).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    directory, depth = [(0, 0)], 0  # slot -> (first prefix of its bucket, the bucket's own depth)
    while True:
        split = {}
        for at, own in set(directory):
            width = 1 << (deepest - own)
            if own < deepest and total[at + width] - total[at] > capacity:
                split[(at, own)] = ((at, own + 1), (at + width // 2, own + 1))
        if not split:
            return np.repeat([at for at, _ in directory], 1 << (deepest - depth))
        if any(own == depth for _, own in split):
            directory, depth = [bucket for bucket in directory for _ in (0, 1)], depth + 1
        for slot, bucket in enumerate(directory):
            if bucket in split:
                upper = (slot >> (depth - bucket[1] - 1)) & 1
                directory[slot] = split[bucket][upper]


def _local_groups(key_bits: int, directory: np.ndarray):
    """mapInArrow: equal texts of a task as one row (bucket, key, sha, body, n,
    top); what is held is bounded by bytes and passed on when full."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    rest = 64 - (len(directory).bit_length() - 1)

    def flush(seen: dict[bytes, list]) -> pa.RecordBatch:
        shas = [hashlib.sha256(body).digest() for body in seen]
        keys = [_key(s, key_bits) for s in shas]
        slots = [(k & (1 << 64) - 1) >> rest for k in keys]
        out = pa.record_batch([pa.array(c, k) for c, k in zip(
            (directory[slots], keys, shas, list(seen),
             [v[0] for v in seen.values()], [v[1] for v in seen.values()]), kinds)],
            names=["bucket", "key", "sha", "body", "n", "top"])
        seen.clear()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}
        held = 0
        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = (body.as_py() or b"").lower()
                got = seen.get(body)
                if got is None:
                    seen[body] = [1, key]
                    held += len(body) + 200
                    if held > _LOCAL_BYTES:
                        yield flush(seen)
                        held = 0
                else:
                    got[0] += 1
                    if key is not None and (got[1] is None or key > got[1]):
                        got[1] = key
        if seen:
            yield flush(seen)
    return run


def _keys(key_bits: int, with_body: bool):
    """mapInArrow: every row's hash and key, with the normalised text if wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [(b.as_py() or b"").lower() for b in batch.column(1)]
            shas = [hashlib.sha256(b).digest() for b in bodies]
            columns = [batch.column(0), pa.array(shas, pa.binary()),
                       pa.array([_key(s, key_bits) for s in shas], pa.int64())]
            names = ["id", "sha", "key"]
            if with_body:
                columns, names = [*columns, pa.array(bodies, pa.binary())], [*names, "body"]
            yield pa.record_batch(columns, names=names)
    return run


def _key(sha: bytes, key_bits: int) -> int:
    """The first ``key_bits`` of the hash, as a signed 64-bit number."""
    top = int.from_bytes(sha[:8], "big") >> (64 - key_bits) << (64 - key_bits)
    return top - (1 << 64) if top >= 1 << 63 else top


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow on rows in key order: one row per different text of a key,
    with its place in the key's chain; the text itself only where it has company."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    names = ["bucket", "key", "link", "links", "body", "n", "top"]
    done: list[tuple] = []
    at: tuple | None = None
    chain: list[list] = []

    def close() -> None:
        for link, (body, n, top) in enumerate(chain):
            done.append((*at, link, len(chain), body if len(chain) > 1 else None, n, top))

    for batch in batches:
        for bucket, key, body, n, top in zip(*(batch.column(i) for i in range(5))):
            here, body = (bucket.as_py(), key.as_py()), body.as_py()
            if here != at:
                close()
                at, chain = here, []
            for entry in chain:
                if entry[0] == body:
                    entry[1] += n.as_py()
                    entry[2] = max((v for v in (entry[2], top.as_py()) if v is not None), default=None)
                    break
            else:
                chain.append([body, n.as_py(), top.as_py()])
        if len(done) > 10_000:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
    close()
    if done:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. ``keep_id`` is the group's largest id. Null ids are smaller than any
    other; in a group without any id ``keep_id`` is null and every row is kept.
    Rows that repeat the largest id are all kept: they are the same document.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = only(docs, id=id_col, body=text_col).withColumn("body", F.col("body").cast("binary"))
    keyed = spill(rows.mapInArrow(_keys(key_bits, False), "id long, sha binary, key long"), "keys")
    slot = F.shiftrightunsigned("key", 64 - max_depth)
    counts = np.zeros(1 << max_depth, np.int64)
    for at, n in keyed.select("key").distinct().groupBy(slot.alias("slot")).count().collect():
        counts[at] = n  # at most 2^max_depth rows
    # buckets by rank: each is one owner task
    starts, directory = np.unique(build_directory(counts, capacity), return_inverse=True)
    buckets = len(starts)

    groups = (rows.mapInArrow(_local_groups(key_bits, directory), "bucket long, key long, sha binary, body binary, "
                                                              "n long, top long")
              .repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "key", "sha")
              .select("bucket", "key", "body", "n", "top"))
    index = spill(groups.mapInArrow(_chained, "bucket long, key long, link int, links int, body binary, "
                                              "n long, top long"), "index", partition_by="bucket")

    alone = index.where("links = 1").select("key", "n", "top")
    found = keyed.join(alone, "key").select("id", "sha", "n", "top")
    crowded = index.where("links > 1").select("key", "body", "n", "top")
    if not crowded.isEmpty():
        texts = rows.mapInArrow(_keys(key_bits, True), "id long, sha binary, key long, body binary")
        found = found.unionByName(texts.join(crowded, ["key", "body"]).select("id", "sha", "n", "top"))
    return found.select("id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"),
                        F.coalesce(F.col("id") == F.col("top"), F.col("top").isNull()).alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"))
