"""How quality filters interact: truth-table survival words.

Every document becomes one 32-bit word, the truth table of its survival: bit S
is set if the document passes all filters of the subset S of the five. The
words of a (part, label) class are counted position by position with carry-save
adders: full adders turn three words of one weight into a sum word and a carry
word of twice the weight, 32 positions at a time, until at most two words of
each weight are left, whose bits are then read. So a task turns its documents
into 32 subset survivor counts a class, and all that is shuffled is one row a
task and class.

What an order of the filters does follows from the survivors of its prefixes:
nothing needs the documents again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import only, split_join

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
HELD_WORDS = 1 << 16   # words of a class that a task holds before it counts them
HELD_CLASSES = 4096    # classes for which a task holds words or counts

#: survival word by failure mask: bit S is set if no filter of S is failed
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the uint32 ``words`` have each of the 32 bits set."""
    counts = np.zeros(32, np.int64)
    weight, level = 1, np.asarray(words, np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            cut = len(level) // 3 * 3
            a, b, c = level[:cut].reshape(3, -1)
            odd = a ^ b
            carries.append(a & b | odd & c)
            level = np.concatenate([odd ^ c, level[cut:]])
        for word in level.tolist():
            counts += weight * (word >> np.arange(32) & 1)
        weight, level = 2 * weight, np.concatenate(carries) if carries else np.zeros(0, np.uint32)
    return counts


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (part, failed, good, toxic) -> (part, label, n): survivors of
    each subset among all documents (label 0), good (1) and toxic ones (2)."""
    held: dict[tuple[str, int], list[np.ndarray]] = {}
    sizes: dict[tuple[str, int], int] = {}
    counts: dict[tuple[str, int], np.ndarray] = {}

    def count(at: tuple[str, int]) -> None:
        counts[at] = counts.get(at, 0) + positional_counts(np.concatenate(held.pop(at)))
        sizes.pop(at)

    def flush() -> pa.RecordBatch:
        for at in list(held):
            count(at)
        rows = [(part, label, n.tolist()) for (part, label), n in counts.items()]
        counts.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int32(), pa.list_(pa.int64())))],
                               names=["part", "label", "n"])

    for batch in batches:
        part = batch.column(0).dictionary_encode()
        names, code = part.dictionary.to_pylist(), part.indices.to_numpy()
        words = WORDS[batch.column(1).to_numpy()]
        good, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        for label, mine in enumerate((np.ones(len(words), bool), good, toxic)):
            for k, name in enumerate(names):
                chosen = words[mine & (code == k)]
                if not len(chosen):
                    continue
                at = (name, label)
                held.setdefault(at, []).append(chosen)
                sizes[at] = sizes.get(at, 0) + len(chosen)
                if sizes[at] >= HELD_WORDS:
                    count(at)
        if len(held) + len(counts) >= HELD_CLASSES:
            yield flush()
    if held or counts:
        yield flush()


def failures(body: Column) -> list[Column]:
    """The failure conditions A to D of a text (E needs the other texts)."""
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(body) - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 200, 100 * distinct < 50 * n, 100 * upper > 3 * F.length(body), body.rlike(r"[#$%&*|]")]


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang", label_id: str = "doc_id", good_col: str = "quality",
                  toxic_col: str = "toxic") -> DataFrame:
    """(id, part, failed, good, toxic) per row of ``docs``: bit i of ``failed``
    is filter i's failure. A null part is the empty string, a null text empty.
    A row fails E if a row with a smaller id has the same text; rows that
    repeat an id and a text do not fail by one another, and a row without an id
    never fails. A document is good (toxic) if any label row of its id says so."""
    named = only(docs, id=id_col, body=text_col, part=part_col)
    body = F.coalesce(F.col("body"), F.lit(""))
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures(body))), F.lit(0))
    named = named.select("id", F.coalesce("part", F.lit("")).alias("part"), bits.alias("failed"),
                         F.sha2(body.cast("binary"), 256).alias("digest"))
    firsts = (named.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .where("first < last").select("digest", "first"))
    marks = (only(labels, id=label_id, good=good_col, toxic=toxic_col).where("id is not null").groupBy("id")
             .agg(F.max(F.col("good") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    repeated = F.when(F.col("id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return (split_join(named, firsts, ["digest"], "left")
            .select("id", "part", (F.col("failed") + repeated).alias("failed"))
            .join(marks, "id", "left")
            .select("id", "part", "failed", F.coalesce("good", F.lit(False)).alias("good"),
                    F.coalesce("toxic", F.lit(False)).alias("toxic")))


def subset_survivors(masks: DataFrame) -> DataFrame:
    """(part, label, n): n[S] documents of the part and label pass all filters of S."""
    per_task = masks.select("part", "failed", "good", "toxic").mapInArrow(
        _survivors, "part string, label int, n array<long>")
    return per_task.groupBy("part", "label").agg(
        F.array(*[F.sum(F.col("n")[s]) for s in range(SUBSETS)]).alias("n"))


def _steps() -> list[tuple]:
    """(order, step, filter, subset before, subset after) for every order and step."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[i] for i in order), step, f, before, before | 1 << f))
            before |= 1 << f
    return out


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (part, everything, good, toxic), survivors by subset, -> one
    row for each order and step; 600 rows a part."""
    orders, step, f, before, after = (np.array(c) for c in zip(*_steps()))
    alone, full = after - before, SUBSETS - 1
    names = pa.array(orders.tolist())
    for batch in batches:
        for part, everything, good, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            n, good, toxic = (np.array(c, np.int64) for c in (everything, good, toxic))
            removed = n[before] - n[after]
            over_all = np.array([removed[f == k].sum() for k in range(len(FILTERS))])
            columns = [n[after], removed, n[0] - n[alone] - removed, n[full - alone] - n[full],
                       good[before] - good[after], toxic[before] - toxic[after], over_all[f]]
            yield pa.record_batch([pa.array([part] * len(step)), names, pa.array(step.astype(np.int32)),
                                   *map(pa.array, columns)], names=["part", "filter_order", "step", *EFFECTS])


EFFECTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, order of the five filters and step: ``kept``,
    ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``
    and ``shapley`` (the filter's removals summed over all orders).

    Parts without good or toxic documents have zeros; a table without rows has
    no parts. See :func:`failure_masks` for nulls and repeated rows; extra
    columns are ignored.
    """
    none = F.array(*[F.lit(0).cast("long")] * SUBSETS)
    parts = (subset_survivors(failure_masks(docs, labels, **columns)).groupBy("part")
             .agg(*[F.coalesce(F.max(F.when(F.col("label") == k, F.col("n"))), none).alias(name)
                    for k, name in enumerate(("everything", "good", "toxic"))]))
    return parts.mapInArrow(_effects, "part string, filter_order string, step int, "
                            + ", ".join(f"{c} long" for c in EFFECTS))
