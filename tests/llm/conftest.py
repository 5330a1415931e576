import os

import pytest

SF = "/root/testdata/sf0.001"

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver test data absent")
    return SF


@pytest.fixture(scope="session")
def documents(sf):
    import pyarrow.parquet as pq
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text) as a documents table over several partitions."""
    def run(rows, source="s", lang="en"):
        data = [(i, t, lang, source, len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(data, DOC).repartition(3)
    return run
