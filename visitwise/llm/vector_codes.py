"""Vector code compression with norm-of-sum bounds.

Vectors of integers are cut into equal parts; each part position has a codebook
trained by rounds of exact k-means, and a vector's code is the index of the
nearest entry at each position.

A round does not search every codebook anew. The history of all rounds'
codebooks is kept, and a (vector, position) keeps its entry, a lower bound on
its distance to every other entry, and the round in which that bound was
measured. In a later round the bound is lowered by how far the entries really
moved since that round, the norm of the sum of their moves; this is never more
than the sum of the moves' norms, which a running total would take off. If the
distance to the own entry is below that, the entry is still the nearest one;
otherwise the codebook is searched exactly and the bound measured again.

Entries are integers and all distances are exact integers; bounds are floats,
rounded to the safe side by a margin, and only a strict gap skips a search, so
ties go to the lower index as in a full search.

Rows live in tables of the shared folder between rounds. A round's sums are
folded in the tasks and by one aggregation; the driver sees codebooks only,
whose size is set by the parameters and the vectors' dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import only, spill, split_join

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LIMIT = 1 << 24   # largest component: squared distances stay exact in 64 bits
MARGIN = 1e-6     # relative, of every bound

NEVER = 255       # the stamp of a bound that was never measured


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vector): components floor(scale * x) as longs; rows whose
    vector is null or holds null or non-finite components are left out."""
    x = F.col("vector")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (only(vectors, id=id_col, vector=vector_col, label=label_col)
            .where(x.isNotNull() & finite)
            .select("id", "label", F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vector")))


def _distances(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, (vectors, entries)."""
    return ((vectors[:, None, :] - entries[None, :, :]) ** 2).sum(2)


def nearest(vectors: np.ndarray, entries: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Full search: the nearest entry (ties to the lower index), and a lower
    bound on the distance to any other (infinite where there is none)."""
    own, bound = np.zeros(len(vectors), np.uint8), np.full(len(vectors), np.inf)
    for at in range(0, len(vectors), step):
        d = _distances(vectors[at:at + step], entries)
        best = d.argmin(1)
        own[at:at + step] = best
        if len(entries) > 1:
            d[np.arange(len(d)), best] = np.iinfo(np.int64).max
            bound[at:at + step] = np.sqrt(d.min(1).astype(np.float64)) * (1 - MARGIN)
    return own, bound


def moved(now: np.ndarray, then: np.ndarray) -> np.ndarray:
    """For each entry, the largest true displacement among the other entries."""
    d = np.sqrt(((now - then) ** 2).sum(1).astype(np.float64)) * (1 + MARGIN)
    if len(d) == 1:
        return np.zeros(1)
    top = np.argsort(-d, kind="stable")[:2]
    out = np.full(len(d), d[top[0]])
    out[top[0]] = d[top[1]]
    return out


def assign(vectors: np.ndarray, history: list[np.ndarray], codes: np.ndarray, bounds: np.ndarray,
           stamps: np.ndarray) -> int:
    """Assign one position's vectors to the newest codebook of ``history``,
    changing codes, bounds and stamps in place; returns how many were searched."""
    now = len(history) - 1
    entries = history[now]
    own = ((vectors - entries[codes]) ** 2).sum(1)
    upper = np.sqrt(own.astype(np.float64)) * (1 + MARGIN)
    lower = np.full(len(vectors), -np.inf)
    for then in np.unique(stamps):
        if then <= now:  # later stamps mean: never searched
            at = stamps == then
            lower[at] = bounds[at] - moved(entries, history[then])[codes[at]]
    search = np.flatnonzero(~(upper < lower))
    codes[search], bounds[search] = nearest(vectors[search], entries)
    stamps[search] = now
    return len(search)


def _round(history: list[np.ndarray], sums: bool):
    """mapInArrow function of a round: the rows with the newest assignment, or
    with ``sums`` the task's sums per (position, entry, component) instead."""
    parts, entries, width = history[-1].shape

    def batch_state(batch: pa.RecordBatch):
        n = batch.num_rows
        cols = {name: batch.column(name) for name in batch.schema.names}
        vectors = np.frombuffer(b"".join(cols["vector"].to_pylist()), "<i4").reshape(n, parts, width).astype(np.int64)
        state = [np.frombuffer(b"".join(cols[c].to_pylist()), k).reshape(n, parts).copy()
                 for c, k in (("codes", "u1"), ("bounds", "<f8"), ("stamps", "u1"))]
        return vectors, state

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, (codes, bounds, stamps) = batch_state(batch)
            for p in range(parts):
                mine = [np.ascontiguousarray(a[:, p]) for a in (codes, bounds, stamps)]
                assign(vectors[:, p], [h[p] for h in history], *mine)
                codes[:, p], bounds[:, p], stamps[:, p] = mine
            out = [pa.array([row.tobytes() for row in a], pa.binary()) for a in (codes, bounds, stamps)]
            yield pa.record_batch([batch.column("id"), batch.column("label"), batch.column("vector"), *out],
                                  names=["id", "label", "vector", "codes", "bounds", "stamps"])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, (codes, _, _) = batch_state(batch)
            for p in range(parts):
                np.add.at(total[p], codes[:, p], vectors[:, p])
                count[p] += np.bincount(codes[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.record_batch([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]),
                               pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], names=["p", "e", "n", "sums"])

    return folded if sums else assigned


def _new_codebooks(state: DataFrame, history: list[np.ndarray]) -> np.ndarray:
    """Each used entry becomes the floor of its vectors' mean."""
    width = history[-1].shape[2]
    per_task = state.mapInArrow(_round(history, sums=True), "p int, e int, n long, sums array<long>")
    rows = per_task.groupBy("p", "e").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}")
                                                                   for i in range(width)]).collect()
    out = history[-1].copy()
    for r in rows:  # at most positions x entries rows
        out[r["p"], r["e"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, vector of longs) -> (id, label, codes, error) and the
    final codebooks (position, entry, component).

    ``codes`` is binary, one byte a position; ``error`` the squared distance
    over all positions. Codebooks start as the parts of the ``entries`` rows
    with the smallest ids (rows without an id last, ties by the vector); with
    fewer rows there are fewer entries. The first of these rows sets the
    dimension, which must be a multiple of ``parts``; a row of another
    dimension is an error, and so is a component beyond ``LIMIT``. No rows give
    no rows and empty codebooks. Repeated ids are rows of their own.
    """
    if not 1 <= entries <= 256 or not 0 <= rounds < NEVER:
        raise ValueError("codes and round stamps are bytes: 1 to 256 entries, at most 254 rounds")
    first = [r["vector"] for r in vectors.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector")
             .limit(entries).collect()]
    if not first:
        empty = vectors.select("id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    dimension = len(first[0])
    if dimension % parts or not dimension:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    width = dimension // parts
    bad = F.exists("vector", lambda v: F.abs(v) > LIMIT) | (F.size("vector") != dimension)
    checked = vectors.withColumn("vector", F.when(bad, F.raise_error(F.lit(
        f"a vector has another dimension than {dimension}, or a component beyond {LIMIT}"))).otherwise(F.col("vector")))
    if any(len(v) != dimension or max(map(abs, v)) > LIMIT for v in first):
        raise ValueError(f"a vector has another dimension than {dimension}, or a component beyond {LIMIT}")

    history = [np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()]

    def fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            raw = batch.column("vector").flatten().to_numpy().astype("<i4").reshape(n, dimension)
            same = {"codes": bytes(parts), "bounds": bytes(8 * parts), "stamps": bytes([NEVER]) * parts}
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array([v.tobytes() for v in raw], pa.binary()),
                                   *[pa.array([b] * n, pa.binary()) for b in same.values()]],
                                  names=["id", "label", "vector", *same])

    keys = f"id long, label {vectors.schema['label'].dataType.simpleString()}"
    kept = f"{keys}, vector binary, codes binary, bounds binary, stamps binary"
    state = checked.mapInArrow(fresh, kept)
    for k in range(rounds):
        state = spill(state.mapInArrow(_round(history, sums=False), kept), f"round{k}")
        history.append(_new_codebooks(state, history))
    final = history[-1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _round(history, sums=False)(batches):
            n = batch.num_rows
            vectors = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").reshape(n, parts, width).astype(np.int64)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts)
            chosen = final[np.arange(parts)[None, :], codes]
            yield pa.record_batch([batch.column("id"), batch.column("label"), batch.column("codes"),
                                   pa.array(((vectors - chosen) ** 2).sum((1, 2)))], names=["id", "label", "codes", "error"])

    return state.mapInArrow(measured, f"{keys}, codes binary, error long"), final


def decoded(codes: bytes, codebooks: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([codebooks[p, c] for p, c in enumerate(codes)]) if codes else np.zeros(0, np.int64)


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over its label (rows
    without one together): one narrow sum per label, joined so that a hot
    label's rows can be split."""
    keyed = coded.withColumn("of", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    totals = keyed.groupBy("of").agg(F.sum("error").alias("label_error"))
    return split_join(keyed, totals, ["of"]).drop("of")
