"""Near-duplicate classes by MinHash bands and odd sketches.

A document's set holds the hashes (64 bit) of its distinct word shingles.
MinHash samples over several permutations are cut into bands; documents that
share a band are candidates. The samples of one permutation in many bins (the
smallest hash of each) are folded into a parity bitmap, an odd sketch: the
population count of two bitmaps' XOR estimates a high similarity closely, so
few false candidates reach the full sets, on which every link is confirmed. Two
shingles count as equal when their 64-bit hashes are: among a million different
ones that goes wrong with probability 3e-8, and would shift a similarity by 1e-6.

No bucket is ever expanded into its pairs:

1. equal sets collapse to one class first (map-side combined);
2. every class is confirmed against one hub, the bucket minimum whose sketch is
   nearest to its own, and what is confirmed is contracted (connected
   components);
3. in buckets that still hold several components, blocks of members compare
   their sketches inside a task, which hands on a spanning forest of the pairs
   that pass and lie in different components: the groups of doubtful classes;
4. in each group, blocks of members compare their full sets, all pairs at once
   by a product of their incidence matrices, and hand on a spanning forest of
   the links. Blocks of the group's main component meet only blocks of the rest;
   they are bounded by members and by shingles.

Work inside a block grows with the square of the block, rows do not. The chance
that a pair at the threshold shares no band is (1 - s^4)^32, below 1e-10 at
s = 0.85 and about 5e-8 at s = 0.80; the sketch cut lies six standard deviations out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import connected_components, only, spill, split_join

SHINGLE_WORDS = 5
BANDS = 32
ROWS = 4
SKETCH_BINS = 1024
SKETCH_BITS = 2048
SKETCH_BLOCK = 2000  # members of a bucket that one piece of work compares by sketch
SET_BLOCK = 512      # members of a group that one piece of work compares by full set
SET_SHINGLES = 4_000_000  # their shingles, so that very long texts do not fill a worker
THRESHOLD_PERCENT = 85

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift-multiply rounds), vectorised."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x9E3779B97F4A7C15)
    x = x ^ (x >> _U(29))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def shingle_set(text: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are runs of bytes outside ASCII white space (0x20, 0x09-0x0D) after
    lower-casing A-Z. With fewer words than ``size`` the whole sequence is the
    only shingle; without words (or a null text) the set is empty.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    width = min(size, len(words))
    acc = np.full(len(words) - width + 1, width, _U)  # the width keeps short sequences apart
    for i in range(width):
        acc = _mix(acc ^ h[i:len(h) - width + 1 + i])
    return np.unique(acc)


def _parameters(samples: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 2**31, samples, np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 2**32, samples, np.uint32))


def minhash(shingles: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """One 32-bit MinHash sample for each (mul, add); blocks bound the memory."""
    low = np.full(len(mul), 2**32 - 1, np.uint32)
    h = (shingles >> _U(32)).astype(np.uint32)
    for i in range(0, len(h), 4096):
        part = h[i:i + 4096]
        np.minimum(low, (mul[:, None] * part[None, :] + add[:, None]).min(axis=1), out=low)
    return low


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents x samples) -> (documents x bands) 64-bit keys, band number mixed in."""
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), (len(samples), bands))
    for r in range(rows):
        acc = _mix(acc ^ samples[:, r:bands * rows:rows].astype(_U))
    return acc


def odd_sketch(shingles: np.ndarray, bins: int, bits: int) -> np.ndarray:
    """Parities of the MinHash samples, in words of 64. The set is sorted, so
    the smallest hash of each bin (its high bits) is the bin's first."""
    at = shingles >> _U(64 - (bins.bit_length() - 1))
    first = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.empty(0, bool)
    flips = np.bincount((_mix(shingles[first]) % _U(bits)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8)).view(_U)


def sketch_cut(n: np.ndarray, percent: int, bins: int, bits: int) -> np.ndarray:
    """Largest XOR population count that a link may show; ``n``: the mean size of the two sets.

    At the threshold 2n(1-s)/(1+s) shingles differ. One of them is its bin's
    sample with probability (1-e^-l)/l, l = n / bins, and changes two samples
    or, where the other bin is empty, one. Expectation plus six deviations.
    """
    s = percent / 100
    differ, load = 2 * n * (1 - s) / (1 + s), np.maximum(n, 1) / bins
    empty = np.exp(-load)
    sampled = (1 - empty) / load
    flips = differ * sampled * (2 - empty)
    spread = differ * (sampled * (4 - 3 * empty) - (sampled * (2 - empty)) ** 2)
    expect = bits / 2 * (1 - np.exp(-2 * flips / bits))
    fold = bits / 4 * (1 - np.exp(-4 * flips / bits)) - flips * np.exp(-4 * flips / bits)
    return np.ceil(expect + 6 * np.sqrt(spread * np.exp(-4 * flips / bits) + np.maximum(fold, 1)))


def _signatures(size: int, bands: int, rows: int, bins: int, bits: int):
    """mapInArrow function: (id, body) -> signatures. Batches are cut to a
    bounded number of documents, so memory does not follow the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _parameters(bands * rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                ids, bodies = batch.slice(at, 2000).columns
                counts, prints = [], []
                samples = np.zeros((len(ids), bands * rows), np.uint32)
                odd = np.zeros((len(ids), bits // 64), _U)
                for i, body in enumerate(bodies):
                    s = shingle_set(body.as_py(), size)
                    counts.append(len(s))
                    prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    if len(s):
                        samples[i], odd[i] = minhash(s, mul, add), odd_sketch(s, bins, bits)
                keys = band_keys(samples, bands, rows)
                yield pa.record_batch(
                    [ids, pa.array(counts, pa.int64()), pa.array(prints, pa.binary()),
                     pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                     pa.array(list(odd.view(np.int64)), pa.list_(pa.int64()))],
                    names=["id", "n", "print", "keys", "odd"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                ids, bodies = batch.slice(at, 1000).columns
                yield pa.record_batch(
                    [ids, pa.array([shingle_set(b.as_py(), size).tobytes() for b in bodies], pa.binary())],
                    names=["id", "shingles"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y)) if min(len(x), len(y)) * 100 >= max(
                    len(x), len(y)) * percent else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).append_column("linked", pa.array(keep, pa.bool_()))
    return run


def _pieces(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The runs of rows that agree in the first ``keys`` columns (whole
    numbers); the rows must come in their order. One run is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns[:keys]]
        cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist(), batch.num_rows]
        if held and any(held[-1].column(i)[-1].as_py() != c[0] for i, c in enumerate(columns)):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _forest(pairs: np.ndarray, members: np.ndarray, components: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of (i, j) pairs as (member, member); members of one
    component count as joined beforehand."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out, names = [], members if components is None else components
    for i, j in pairs.tolist():
        a, b = find(int(names[i])), find(int(names[j]))
        if a != b:
            root[a] = b
            out.append((int(members[i]), int(members[j])))
    return out


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _doubtful(percent: int, bins: int, bits: int):
    """mapInArrow on (key, x, y, block, rep, comp, n, odd): in each piece the
    pairs of block x with block y that lie in different components and pass the
    sketches, as a spanning forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for piece in _pieces(batches, 3):
            x, y = piece["x"][0].as_py(), piece["y"][0].as_py()
            block, rep, comp, n = (piece[c].to_numpy() for c in ("block", "rep", "comp", "n"))
            odd = piece["odd"].combine_chunks().flatten().to_numpy().view(_U).reshape(len(rep), -1)
            right = np.flatnonzero(block == y)
            pairs = []
            for i in np.flatnonzero(block == x):
                far = np.bitwise_count(odd[right] ^ odd[i]).sum(axis=1)
                size = (n[right] + n[i]) / 2
                near = (far <= sketch_cut(size, percent, bins, bits)) & (comp[right] != comp[i]) & (
                    100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i]))
                pairs += [(i, j) for j in right[near]]
            found += _forest(np.array(pairs, np.int64).reshape(-1, 2), rep)
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)
    return run


def _confirmed(percent: int):
    """mapInArrow on (group, x, y, block, rep, comp, shingles): in each piece
    the links of block x with block y, on the full sets, as a spanning forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 3):
            x, y = piece["x"][0].as_py(), piece["y"][0].as_py()
            block, rep, comp = (piece[c].to_numpy() for c in ("block", "rep", "comp"))
            sets = [np.frombuffer(v.as_buffer(), _U) for c in piece["shingles"].chunks for v in c]
            size = np.array([len(s) for s in sets])
            # columns: the shingles that two members share; the others add nothing to a product
            _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = count[column] > 1
            name = np.cumsum(count > 1) - 1
            member = np.repeat(np.arange(len(sets)), size)[shared]
            column = name[column[shared]]
            both = np.zeros((len(sets), len(sets)), np.float32)
            for at in range(0, int((count > 1).sum()), 4096):  # bounded memory
                inside = (column >= at) & (column < at + 4096)
                part = np.zeros((len(sets), 4096), np.float32)
                part[member[inside], column[inside] - at] = 1
                both += part @ part.T
            linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
            linked &= (comp[:, None] != comp[None, :]) & (block == x)[:, None] & (block == y)[None, :]
            yield _edges(_forest(np.argwhere(linked), rep, comp))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT,
                    bands: int = BANDS, rows: int = ROWS, bins: int = SKETCH_BINS,
                    bits: int = SKETCH_BITS) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, ``component_id`` (smallest
    id reachable over links, itself included) and ``kept``.

    Links join documents whose sets satisfy
    ``100 * intersection >= percent * union``. Null, empty and wordless texts
    have an empty set and no link. Rows that share an id are one node and all
    get its component. A row without an id links nothing: its component is
    null and it is kept. Extra columns are ignored; an empty table gives an
    empty result.
    """
    sig = spill(only(docs, id=id_col, body=text_col).withColumn("body", F.col("body").cast("binary"))
                .mapInArrow(_signatures(size, bands, rows, bins, bits),
                            "id long, n long, print binary, keys array<long>, odd array<long>"), "signatures")
    known = sig.where("id is not null and n > 0")
    # equal sets: one class, represented by its smallest id
    classes = spill(known.groupBy("print").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.first("odd").alias("odd")), "classes")
    # rows that share an id but not a text tie their classes together
    repeated = known.groupBy("id").agg(F.min("print").alias("lo"), F.max("print").alias("hi")).where("lo <> hi").select("id")
    tied = None
    if not repeated.isEmpty():
        member = known.join(repeated, "id").join(classes.select("print", "rep"), "print").select("id", "rep")
        tied = (member.join(member.groupBy("id").agg(F.min("rep").alias("a")), "id")
                .select("a", F.col("rep").alias("b")).where("a <> b"))

    band = classes.select("rep", F.explode("keys").alias("key"))
    hot = band.groupBy("key").agg(F.count("*").alias("c"), F.min("rep").alias("hub")).where("c > 1").select("key", "hub")
    inside = spill(split_join(band, hot, ["key"]).select("key", "rep", "hub").distinct(), "members")
    odd = classes.select("rep", "n", "odd")

    # the full sets of classes that have a candidate, by their representative
    wanted = inside.select(F.col("rep").alias("id")).distinct()
    sets = spill(only(docs, id=id_col, body=text_col)
                 .join(wanted, "id", "left_semi").withColumn("body", F.col("body").cast("binary"))
                 .mapInArrow(_sets(size), "id long, shingles binary").distinct(), "sets")

    # one hub for each class: the nearest by sketch
    apart = " + ".join(f"bit_count(x.odd[{i}] ^ y.odd[{i}])" for i in range(bits // 64))
    star = (inside.where("rep <> hub").select("rep", "hub").distinct()
            .join(odd.alias("x"), "rep").join(odd.alias("y"), F.col("hub") == F.col("y.rep"))
            .where(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
            .select(F.col("x.rep").alias("b"), F.struct(F.expr(apart).alias("far"), F.col("hub").alias("a")).alias("p"))
            .groupBy("b").agg(F.min("p").alias("p")).select("p.a", "b"))
    both = (star.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))
    links = spill(both.mapInArrow(_confirm(percent), "a long, b long, linked boolean").where("linked").select("a", "b"),
                  "star")
    # a class has one hub at most, and hubs have hubs: two steps towards the smallest are a fair first contraction
    up = links.select(F.col("b").alias("a"), F.col("a").alias("next"))
    comp = spill(links.join(up, "a", "left").select(F.col("b").alias("node"), F.coalesce("next", "a").alias("component")),
                 "components")
    links = links.unionByName(tied) if tied is not None else links

    def placed(rows: DataFrame) -> DataFrame:
        return (rows.join(comp, F.col("rep") == F.col("node"), "left").drop("node")
                .withColumn("comp", F.coalesce("component", "rep")).drop("component"))

    # buckets with several components: the pairs that the sketches cannot rule out
    several = placed(inside.select("key", "rep"))
    mixed = (several.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
             .where("lo <> hi").select("key", F.ceil(F.col("c") / SKETCH_BLOCK).cast("int").alias("blocks")))
    work = (split_join(several, mixed, ["key"]).join(odd, "rep")
            .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                    "block", "rep", "comp", "n", "odd"))
    order = ("key", "x", "y")
    pairs = spill(work.repartition(*order).sortWithinPartitions(*order)
                  .mapInArrow(_doubtful(percent, bins, bits), "a long, b long").distinct(), "doubtful")
    if not pairs.isEmpty():
        groups = spill(placed(connected_components(pairs).select(F.col("node").alias("rep"), F.col("component").alias("grp")))
                       .join(classes.select("rep", "n"), "rep"), "groups")
        largest = F.struct("c", "comp", "n")
        main = (groups.groupBy("grp", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("n")).groupBy("grp")
                .agg(F.max(largest).alias("m"), F.sum("c").alias("c"), F.sum("n").alias("n"))
                .select("grp", F.col("m.comp").alias("main"), *[
                    F.greatest(F.ceil(members / SET_BLOCK), F.ceil(shingles / SET_SHINGLES)).cast("int").alias(name)
                    for name, members, shingles in (("rest", F.col("c") - F.col("m.c"), F.col("n") - F.col("m.n")),
                                                    ("mains", F.col("m.c"), F.col("m.n")))]))
        # blocks 0 .. rest-1 hold what is outside the main component, the next ones the main component
        place = F.xxhash64("rep")
        work = (groups.join(main, "grp").withColumn("own", F.col("comp") != F.col("main"))
                .withColumn("block", F.when(F.col("own"), F.pmod(place, "rest"))
                            .otherwise(F.col("rest") + F.pmod(place, "mains")).cast("int"))
                .withColumn("other", F.explode(F.when(F.col("own"), F.expr("sequence(0, rest + mains - 1)"))
                                               .otherwise(F.expr("sequence(0, rest - 1)"))))
                .select(F.col("grp").alias("key"), F.least("block", "other").alias("x"),
                        F.greatest("block", "other").alias("y"), "block", "rep", "comp")
                .join(sets.withColumnRenamed("id", "rep"), "rep").select("key", "x", "y", "block", "rep", "comp", "shingles"))
        more = spill(work.repartition(*order).sortWithinPartitions(*order)
                     .mapInArrow(_confirmed(percent), "a long, b long"), "links")
        links = links.unionByName(more)
    comp = spill(connected_components(links), "components")

    classes = (placed(classes.select("print", "rep"))
               .select("print", F.col("comp").alias("component_id")))
    out = (sig.select("id", "n", "print").join(classes, "print", "left")
           .select("id", F.col("n").alias("n_shingles"),
                   F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
