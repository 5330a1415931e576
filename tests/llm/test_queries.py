"""The corpus queries as registered: names, columns of the contracts, and SQL
against DuckDB where it states them."""

import duckdb
import pytest

import __spark_entry__ as entry
from visitwise.llm.queries import ORACLE, QUERIES

COLUMNS = {
    2: "doc_id n_shingles component_id kept",
    3: "doc_id n_words n_base first_word last_word base_labels labels score",
    5: "doc_id keep_id group_size kept text_sha256",
    6: "doc_id n_assign n_access n_hex base_sha256 spans",
    7: "query_id rank vec_id score",
    9: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    10: "doc_id held_out score predicted",
    11: "page_id payload_bytes payload_digest record_type refers_to",
    12: "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    13: "vec_id code error label_error codebooks_sha256",
}


def test_every_operator_is_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_of_the_contract(spark, sf, name):
    df = QUERIES[name](spark, sf)
    want = COLUMNS.get(int(name[2:].split("_")[0]), "doc_id").split()
    assert set(want) <= set(df.columns)
    n = duckdb.sql(f"select count(*) from '{sf}/documents.parquet'").fetchall()[0][0]
    if "doc_id" in want and name != "op9_vector_packing":
        assert df.count() == n


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(
        (tuple(r[names.index(c)] for c in columns) for r in cur.fetchall()), key=repr)
