"""The corpus pipeline: stages over ``documents``, each one of the operators
of ``visitwise.llm``, written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``; each works on
all that its predecessor kept:

1. toxicity: documents that the classifier chain rejects go;
2. line dedup: repeated lines go, every document stays;
3. MinHash near-dedup at a similarity of 0.80: of each group one document, the
   smallest doc_id, stays;
4. secret scans: live-looking secrets are replaced, every document stays;
5. packing: the texts as pieces of packed token sequences.

Rows without a doc_id pass the filters like any other document: toxicity judges
their texts, and near-dedup keeps them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.llm.base import quoted, spill, table
from visitwise.llm.line_dedup import DISTANCES, EXACT_CHARS, line_dedup
from visitwise.llm.near_dedup import near_duplicates
from visitwise.llm.packing import pack_documents
from visitwise.llm.queries import packing_digest, toxicity_labels
from visitwise.llm.secret_scan import redact
from visitwise.llm.toxicity import without_toxic

NEAR_PERCENT = 80  # the near-dedup stage's own threshold; op2 keeps its contract's


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    labels = toxicity_labels(table(spark, sf_dir, "labels"))
    return without_toxic(docs, labels, ["junk", "toxic"])


def _same_columns(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, the character count following the changed text."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*quoted(docs.columns))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand earlier in the corpus."""
    return _same_columns(docs, line_dedup(docs, distance=DISTANCES, exact_chars=EXACT_CHARS, count_col=None))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity 0.80 or more) the document with
    the smallest doc_id."""
    kept = near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi").select(*quoted(docs.columns))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced."""
    return _same_columns(docs, redact(docs, repo_col=None))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing_digest(pack_documents(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

# no SQL states these stages; tests/llm/test_pipeline.py checks each on its input
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = spill(docs, name)
    return docs
