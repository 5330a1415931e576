"""Toxicity by a classifier chain.

The categories are predicted one after the other, each by a linear (logistic)
model on the document's terms and on the probabilities of the categories
before it. While training, those probabilities are out-of-fold predictions:
each row's come from models that have not seen it, so a later model learns
from probabilities as they will be on new documents.

Terms are words and the beginnings of words. The vocabulary is chosen by the
chi-squared statistic of each term with each category, counted by Spark over a
bounded sample of labelled documents; only terms that speak for a category are
taken, so a text without any of them (an empty one) looks clean. A term gives two features: whether it
occurs, and how dense it is, so one term in a very long text is seen and a
chance occurrence in one does not weigh like a habit.

The last category is a grade of a labelled one: rows of that label whose
vocabulary is at least as dense as the median such row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import only, quoted, slices, spill

SAMPLE_ROWS = 6_000  # most labelled rows that the chain is trained on
VOCABULARY = 160      # terms for each category
LEAST_ROWS = 12       # a term must occur in so many rows of the sample
RARE_ROWS = 600       # rows of the graded category's rarer class that the sample holds at least, if there are
STARTS = (4, 5, 6, 7)
FOLDS = 5
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in STARTS if len(word) > k)]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (id, body) -> id and the distinct terms of the text."""
    for batch in batches:
        out = [sorted({t for w in set(_WORD.findall((b.as_py() or "").lower())) for t in terms_of(w)})
               for b in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["id", "terms"])


class Features:
    """Texts to vectors: for each term of the vocabulary, occurrence and density."""

    def __init__(self, vocabulary: list[str]):
        self.place = {t: i for i, t in enumerate(vocabulary)}
        self.words: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> np.ndarray:
        size, known = len(self.place), self.words
        if len(known) > 200_000:
            known.clear()
        counts = Counter(_WORD.findall(text.lower()))
        hits = np.zeros(size)
        for word, n in counts.items():
            at = known.get(word)
            if at is None:
                at = known[word] = tuple(self.place[t] for t in terms_of(word) if t in self.place)
            for i in at:
                hits[i] += n
        return np.concatenate([hits > 0, np.log1p(100 * hits / max(1, counts.total()))]).astype(np.float32)

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self(t) for t in texts], np.float32).reshape(len(texts), 2 * len(self.place))


class Linear:
    """Logistic regression by full-batch Adam steps on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.02, decay: float = 1e-3):
        some = len(y) > 0
        self.mean = x.mean(axis=0) if some else np.zeros(x.shape[1])
        self.scale = np.maximum(x.std(axis=0), 0.1) if some else np.ones(x.shape[1])
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if some else 1e-6
        z = ((x - self.mean) / self.scale).astype(np.float32)
        w = np.zeros(x.shape[1] + 1, np.float32)
        w[-1] = np.log(share / (1 - share))
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1 if 0 < y.sum() < len(y) else 0):  # one class only: the constant
            d = ((self._sigmoid(z @ w[:-1] + w[-1]) - y) / len(y)).astype(np.float32)
            g = np.append(d @ z + np.float32(decay) * w[:-1], d.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = (w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        self.weights = w

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1])


class Chain:
    """One linear model for each column of ``y``, in order."""

    def __init__(self, x: np.ndarray, y: np.ndarray, folds: int = FOLDS):
        fold = np.arange(len(x)) % max(2, min(folds, len(x)))
        self.models = []
        for column in range(y.shape[1]):
            target = y[:, column].astype(np.float64)
            self.models.append(Linear(x, target))
            unseen = np.zeros(len(x))
            if column + 1 < y.shape[1]:
                for f in np.unique(fold):
                    unseen[fold == f] = Linear(x[fold != f], target[fold != f])(x[fold == f])
            x = np.column_stack([x, unseen])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """(rows x categories) probabilities."""
        out = []
        for model in self.models:
            out.append(model(x))
            x = np.column_stack([x, out[-1]])
        return np.column_stack(out)


def train(docs: DataFrame, labelled: DataFrame, categories: list[str], graded: str, id_col: str, text_col: str,
          sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY,
          least_rows: int = LEAST_ROWS, rare_rows: int = RARE_ROWS) -> tuple[Features, Chain]:
    """The vocabulary and the chain, from at most ``sample_rows`` labelled rows:
    those with the smallest hashes of their ids in each class of the graded
    category, in the classes' shares, but at least ``rare_rows`` of the rarer
    class if there are so many (its probabilities are those of such a sample).
    Of an id's several labels the largest counts; rows with a null id or a null
    label are left out."""
    spark = docs.sparkSession
    columns = {f"y{i}": c for i, c in enumerate(categories)}
    known = (only(labelled, id=id_col, **columns).dropna().groupBy("id")
             .agg(*[F.max(y).cast("int").alias(y) for y in columns]))
    marked = F.col(f"y{categories.index(graded)}") > 0
    has, total = known.agg(F.count_if(marked), F.count("*")).first()
    rare, rarer = (marked, has) if 2 * has <= total else (~marked, total - has)
    share = min(rarer, max(round(sample_rows * rarer / max(1, total)), min(rare_rows, sample_rows // 2)))
    rows = [r for chosen, n in ((rare, share), (~rare, sample_rows - share))
            for r in known.where(chosen).orderBy(F.xxhash64("id"), "id").limit(n).collect()]
    # at most sample_rows rows of numbers: a broadcast of bounded size
    sample = spark.createDataFrame(rows, "id long, " + ", ".join(f"{y} int" for y in columns))
    texts = spill(only(docs, id=id_col, body=text_col).join(F.broadcast(sample), "id"), "sample")

    size = texts.count()
    n = F.lit(float(size))
    totals = texts.agg(*[F.coalesce(F.sum(y), F.lit(0)).cast("double").alias(f"t{y}") for y in columns]).first()
    counts = (texts.select("id", "body").mapInArrow(_terms, "id long, terms array<string>")
              .join(F.broadcast(sample), "id").select(F.explode("terms").alias("term"), *columns)
              .groupBy("term").agg(F.count("*").cast("double").alias("n"),
                                   *[F.sum(y).cast("double").alias(y) for y in columns])
              .where(F.col("n") >= min(least_rows, max(1, len(rows) // 100), max(1, share // 10))))
    best: set[str] = set()
    for y in columns:
        if 0 < totals[f"t{y}"] < size:  # a constant category chooses no terms
            a, t = F.col(y), F.lit(totals[f"t{y}"])
            chi = (a * n - F.col("n") * t) ** 2 / (F.col("n") * (n - F.col("n") + 1) * t * (n - t))
            marking = counts.where(a * n > F.col("n") * t)  # more frequent in the category than elsewhere
            best |= {r["term"] for r in marking.orderBy(chi.desc(), "term").limit(vocabulary).select("term").collect()}
    features = Features(sorted(best))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t or "").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(x, pa.binary())], names=["id", "x"])

    got = {r["id"]: r["x"] for r in texts.select("id", "body").mapInArrow(vectors, "id long, x binary").collect()}
    rows = [r for r in rows if r["id"] in got]
    x = np.array([np.frombuffer(got[r["id"]], np.float32) for r in rows]).reshape(len(rows), 2 * len(features.place))
    y = np.array([[r[c] for c in columns] for r in rows], np.float64).reshape(len(rows), len(categories))
    has = y[:, categories.index(graded)] > 0
    grade = np.zeros(len(rows))
    if has.any() and not has.all():
        # terms that are denser in the graded category, and how much of them a row has
        half = x.shape[1] // 2
        marked = x[has, half:].mean(axis=0) > x[~has, half:].mean(axis=0)
        amount = x[:, half:][:, marked].sum(axis=1)
        grade = (has & (amount >= np.median(amount[has]))).astype(np.float64)
    return features, Chain(x, np.column_stack([y, grade]))


def _scored(docs: DataFrame, features: Features, chain: Chain, text_col: str) -> tuple[DataFrame, list[str]]:
    """``docs`` under names of our own (returned, too) and ``p``, the chain's probabilities."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    named = docs.select(*[c.alias(o) for c, o in zip(quoted(docs.columns), own)])
    body = own[docs.columns.index(text_col)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = chain(features.matrix([t or "" for t in batch.column(body).to_pylist()]))
            yield pa.record_batch([*batch.columns, pa.array(list(p), pa.list_(pa.float64()))],
                                  names=[*batch.schema.names, "p"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields)
    return named.mapInArrow(score, f"{schema}, p array<double>"), own


def without_toxic(docs: DataFrame, labelled: DataFrame, categories: list[str], graded: str = "toxic",
                  id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the chain does not reject, with the columns of
    ``docs``, whatever their names."""
    features, chain = train(docs, labelled, categories, graded, id_col, text_col)
    scored, own = _scored(docs, features, chain, text_col)
    kept = scored.where(~(F.col("p")[categories.index(graded)] >= threshold))
    return kept.select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own)])


def toxicity(docs: DataFrame, labelled: DataFrame, categories: list[str], graded: str = "toxic",
             id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> DataFrame:
    """``docs``, all columns, then ``p_<category>`` for each category and
    ``p_severe``, and ``rejected`` (the graded category's probability is at
    least ``threshold``).

    ``labelled`` holds the id and the categories as 0 or 1. Null, empty and
    wordless texts are scored as texts without any term. Without labels every
    probability is next to 0, with labels of one class next to that class. Rows that repeat
    an id are scored by their own texts. A column of ``docs`` that has the name
    of a new one gives way to it; an empty table gives an empty result.
    """
    features, chain = train(docs, labelled, categories, graded, id_col, text_col, sample_rows, vocabulary)
    out, own = _scored(docs, features, chain, text_col)
    new = {f"p_{c}": F.col("p")[i] for i, c in enumerate([*categories, "severe"])}
    new["rejected"] = F.col("p")[categories.index(graded)] >= threshold
    taken = {n.lower() for n in new}
    return out.select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own) if c.lower() not in taken],
                      *[c.alias(n) for n, c in new.items()])
