"""Quality classifier on random-indexing word vectors.

Words fall into a fixed number of hash buckets. Every bucket has an index
vector: a few +1 and -1 at places drawn from its number. A word's vector is the
sum of the index vectors of all words next to it, over the whole corpus: map
tasks add up their texts, and a shuffle adds the tasks' sums, bucket by bucket.
A document is the mean and the spread of its words' vectors. A network of two
layers, trained with numpy on a bounded sample of labelled documents, scores
it; a temperature fitted on rows kept from training calibrates the
probability.

The table of word vectors (buckets x dimensions) is fixed by parameters, so it
goes to the tasks whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import only

BUCKETS = 1 << 14
DIMENSIONS = 64
NONZERO = 2           # of each sign in an index vector
WINDOW = 2            # words to either side
BLOCK = 256           # buckets of one shuffled row
SAMPLE_ROWS = 20_000  # most labelled rows that the network is trained on
HIDDEN = 32
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_CHUNK = 2_000_000    # words added up at a time


def index_places(buckets: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of every bucket's index vector."""
    rng = np.random.default_rng(7)
    places = rng.integers(0, dimensions, (buckets, 2 * NONZERO))
    return places, np.repeat([1, -1], NONZERO)


_names: dict[str, int] = {}


def word_buckets(text: str, buckets: int) -> np.ndarray:
    """The hash buckets of a text's words and runs of punctuation, in order."""
    words = _TOKEN.findall(text.lower())
    if len(_names) > 300_000:
        _names.clear()
    for w in set(words).difference(_names):
        _names[w] = xxhash.xxh3_64_intdigest(w.encode())
    return np.fromiter(map(_names.__getitem__, words), np.uint64, len(words)).astype(np.int64) % buckets


def add_contexts(total: np.ndarray, words: np.ndarray, breaks: np.ndarray, places, signs, window: int) -> None:
    """Add to ``total`` the index vectors of the neighbours of every word;
    ``breaks`` numbers the text that each word is from."""
    dims = total.shape[1]
    flat = total.reshape(-1)
    for gap in range(1, window + 1):
        same = breaks[gap:] == breaks[:-gap]
        left, right = words[:-gap][same], words[gap:][same]
        for a, b in ((left, right), (right, left)):
            for k, sign in enumerate(signs):
                flat += sign * np.bincount(a * dims + places[b, k], minlength=flat.size)


def _context_sums(buckets: int, dimensions: int, window: int):
    """mapInArrow: body -> (block, offset in it, sums) of the buckets that the task has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_places(buckets, dimensions)
        total = np.zeros((buckets, dimensions), np.int64)
        held: list[np.ndarray] = []
        size = 0

        def add() -> None:
            if held:
                add_contexts(total, np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held]),
                             places, signs, window)
                held.clear()

        def rows() -> Iterator[pa.RecordBatch]:
            seen = np.nonzero(total.any(axis=1))[0]
            if len(seen):
                yield pa.record_batch([pa.array(seen // BLOCK, pa.int64()), pa.array(seen % BLOCK, pa.int64()),
                                       pa.array([total[i].astype(np.int32).tobytes() for i in seen], pa.binary())],
                                      names=["block", "at", "sums"])
            total[:] = 0

        for batch in batches:
            for body in batch.column(0):
                held.append(word_buckets(body.as_py() or "", buckets))
                size += len(held[-1])
                if size > _CHUNK:
                    add()
                    size = 0
                    if np.abs(total).max() >= 1 << 30:  # before 32 bits are too few
                        yield from rows()
        add()
        yield from rows()
    return run


def _added(dimensions: int):
    """mapInArrow on rows of whole blocks: their sums. What is held is bounded by the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, sums in zip(*batch.columns):
                into = blocks.setdefault(block.as_py(), np.zeros((BLOCK, dimensions), np.int64))
                into[at.as_py()] += np.frombuffer(sums.as_buffer(), np.int32)
        if blocks:
            yield pa.record_batch([pa.array(list(blocks), pa.int64()),
                                   pa.array([b.tobytes() for b in blocks.values()], pa.binary())],
                                  names=["block", "sums"])
    return run


def word_vectors(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, dimensions: int = DIMENSIONS,
                 window: int = WINDOW) -> np.ndarray:
    """The table of word vectors (buckets x dimensions), each of length 1, or 0
    where no word has been seen. It covers every text."""
    sums = (only(docs, body=text_col).mapInArrow(_context_sums(buckets, dimensions, window),
                                                 "block long, at long, sums binary")
            .repartition("block").mapInArrow(_added(dimensions), "block long, sums binary"))
    table = np.zeros((-(-buckets // BLOCK), BLOCK, dimensions))
    for block, raw in sums.collect():  # as many rows as blocks
        table[block] = np.frombuffer(raw, np.int64).reshape(BLOCK, dimensions)
    table = table.reshape(-1, dimensions)[:buckets]
    table = np.sign(table) * np.log1p(np.abs(table))
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(length == 0, 1, length)).astype(np.float32)


def pooled(text: str, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of a text's words; zeros without words."""
    words = word_buckets(text, len(table))
    if not len(words):
        return np.zeros(2 * table.shape[1], np.float32)
    found, counts = np.unique(words, return_counts=True)
    share = (counts / len(words)).astype(np.float32)
    vectors = table[found]
    mean = share @ vectors
    return np.concatenate([mean, np.sqrt(np.maximum(share @ vectors ** 2 - mean ** 2, 0))])


def _pooled_rows(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [pooled(t.as_py() or "", table).tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["id", "vector"])
    return run


class Network:
    """x -> tanh(x A + a) -> logit; probability = sigmoid(logit / temperature)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, batch: int = 256,
                 rate: float = 0.003, decay: float = 1e-4):
        rng = np.random.default_rng(11)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        order = rng.permutation(len(x))
        keep = order[:len(x) // 5]  # for the temperature
        rows = order[len(x) // 5:]
        z, y = (x - self.mean) / self.scale, y.astype(np.float64)
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        for _ in range(epochs):
            rng.shuffle(rows)
            for at in range(0, len(rows), batch):
                r = rows[at:at + batch]
                h = np.tanh(z[r] @ p[0] + p[1])
                d = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[r]) / len(r)
                dh = d[:, None] * p[2] * (1 - h ** 2)
                grads = [z[r].T @ dh + decay * p[0], dh.sum(axis=0), h.T @ d + decay * p[2], np.array([d.sum()])]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] - rate * m[i] / (1 - 0.9 ** t) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.layers, self.temperature = p, 1.0
        # the temperature with the least log loss on the rows kept
        if len(keep):
            logit = self.logits(x[keep])
            grid = np.exp(np.linspace(-2, 3, 101))
            loss = [np.mean(np.logaddexp(0, np.where(y[keep] > 0, -logit, logit) / g)) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.layers[0] + self.layers[1])
        return h @ self.layers[2] + self.layers[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


class Constant:
    """The score where the labels hold one class only (or none: 0.5)."""

    def __init__(self, value: float):
        self.value = value

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def train(docs: DataFrame, labelled: DataFrame, table: np.ndarray, id_col: str, text_col: str, label_col: str,
          sample_rows: int = SAMPLE_ROWS) -> Network | Constant:
    """A network from at most ``sample_rows`` rows of ``labelled`` (those with
    the smallest hashes of their ids). An id with several labels counts as its
    largest; null ids and null labels are left out."""
    rows = (only(labelled, id=id_col, y=label_col).where("id is not null and y is not null")
            .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    # at most sample_rows pairs of numbers: a broadcast of bounded size
    rows = docs.sparkSession.createDataFrame(rows.collect() or [], "id long, y int")
    texts = only(docs, id=id_col, body=text_col).join(F.broadcast(rows.select("id")), "id", "left_semi")
    seen = {r["id"]: r["vector"] for r in texts.mapInArrow(_pooled_rows(table), "id long, vector binary").collect()}
    pairs = [(seen[r["id"]], r["y"]) for r in rows.collect() if r["id"] in seen]
    if len({y for _, y in pairs}) < 2:
        return Constant(float(pairs[0][1]) if pairs else 0.5)
    return Network(np.array([np.frombuffer(v, np.float32) for v, _ in pairs]), np.array([y for _, y in pairs]))


def quality_scores(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", buckets: int = BUCKETS, dimensions: int = DIMENSIONS,
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``id`` and ``score`` (0 to 1; higher: label
    1 likelier). Word vectors come from every text, the network from rows of
    ``labelled`` (id, label 0 or 1) whose ids are in ``docs``.

    Null, empty and wordless texts have the score of a zero vector. Without
    labels every score is 0.5, with labels of one class that class. Rows that
    repeat an id are scored by their own texts. Extra columns are ignored; an
    empty table gives an empty result.
    """
    table = word_vectors(docs, text_col, buckets, dimensions)
    model = train(docs, labelled, table, id_col, text_col, label_col, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([pooled(t.as_py() or "", table) for t in batch.column(1)]).reshape(
                batch.num_rows, 2 * table.shape[1])
            yield pa.record_batch([batch.column(0), pa.array(model(x), pa.float64())], names=["id", "score"])

    return only(docs, id=id_col, body=text_col).mapInArrow(run, "id long, score double")
