import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from visitwise.llm import secret_scan
from visitwise.llm.base import quoted, spill, table

from .test_line_dedup import brute_by_length
from .test_near_dedup import brute as near_brute


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows before each stage and after the last, as the pipeline passes them on."""
    docs = table(spark, sf, "documents")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(spill(stage(spark, out[-1], sf), name))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_return_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(stages, sf):
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    kept = {i for i, _ in rows(stages[1])}
    toxic = [i for i, t in labels.items() if t == 1]
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i not in kept for i in toxic) >= 0.9 * len(toxic)
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)


def test_lines_are_gone(stages):
    before, after = rows(stages[1]), dict(rows(stages[2]))
    want = {i: t for (i, _), t in brute_by_length(before).items()}
    assert after == {i: want.get(i) for i, _ in before}
    counts = [r["n_chars"] for r in stages[2].collect()], [len(r["text"]) for r in stages[2].collect()]
    assert counts[0] == counts[1]


def test_one_of_each_group_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    want = [i for i, _, c in near_brute(before, percent=cp.NEAR_PERCENT) if c == i]
    assert sorted(i for i, _ in after) == sorted(want)


def test_live_secrets_are_replaced(stages):
    before, after = rows(stages[3]), dict(rows(stages[4]))
    assert set(after) == {i for i, _ in before}
    owners, repos = {}, {}
    source = {r["doc_id"]: r["source"] for r in stages[3].collect()}
    for i, text in before:
        for *_, value in secret_scan.find_spans(text):
            owners.setdefault(value, set()).add(source[i])
            repos.setdefault(value, set()).add(i)
    for i, text in before:
        want, at = "", 0
        for _, start, end, value in secret_scan.find_spans(text):
            if len(owners[value]) < secret_scan.EXAMPLE_OWNERS and len(repos[value]) < secret_scan.EXAMPLE_REPOS:
                if start >= at:
                    want += text[at:start] + "[SECRET]"
                at = max(at, end)
        assert after[i] == want + text[at:]
    assert any("[SECRET]" in t for t in after.values())


def test_packing_holds_every_document(stages):
    out = stages[5].collect()
    assert {r["doc_id"] for r in out} == {i for i, _ in rows(stages[4])}
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        assert r["offset"] + r["length"] <= 2048
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in out)


def test_run_returns_the_last_stage(spark, sf, stages):
    def digest(df):
        return sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in df.collect() if r["start"] == 0)
    got, want = digest(cp.run(spark, sf)), digest(stages[5])
    assert [g[0] for g in got] == [w[0] for w in want]


def test_empty_documents(spark, sf):
    docs = table(spark, sf, "documents").where("false")
    for name, stage in cp.STAGES:
        docs = spill(stage(spark, docs, sf), name)
    assert docs.count() == 0 and isinstance(np.array([]), np.ndarray)


def test_near_copies_from_080_go(spark, sf, make):
    """Copies between 0.80 and 0.85 go in the stage, those below 0.80 stay."""
    words = [f"w{i}" for i in range(300)]
    data = []
    for i, changed in enumerate([0, 6, 7, 8, 5, 6]):  # similarity to the group's first: 0.66 to 1
        for g in range(4):
            own = [f"g{g}{w}" for w in words]
            for k in range(changed):
                own[k * 31 + 5 + i] = f"x{i}{k}"
            data.append((g * 100 + i, " ".join(own)))
    groups = near_brute(data, percent=80)
    want = sorted(i for i, _, c in groups if c == i)
    assert want != sorted(i for i, _, c in near_brute(data) if c == i)
    assert sorted(i for i, _ in rows(cp.near_dedup_stage(spark, make(data), sf))) == want


def test_near_dedup_stage_matches_brute_force_at_080(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert sorted(i for i, _ in after) == sorted(i for i, _, c in near_brute(before, percent=80) if c == i)


def test_any_extra_columns_pass_through_every_stage(spark, sf):
    docs = table(spark, sf, "documents")
    extra = ["rejected", "p_toxic", "p", "removed_lines", "a.b", "row", "kept", "component_id", "c0", "odd`name"]
    for k, c in enumerate(extra):
        docs = docs.withColumn(c, F.lit(k))
    for name, stage in cp.STAGES[:-1]:
        after = spill(stage(spark, docs, sf), name)
        assert after.dtypes == docs.dtypes, name
        assert after.select(*quoted(extra)).distinct().collect() == [tuple(range(len(extra)))], name
    assert cp.STAGES[-1][1](spark, docs, sf).count() > 0
