"""The operators on the driver's tables: ``QUERIES`` (name -> function of
(spark, sf_dir)) and ``ORACLE`` (name -> DuckDB SQL, where SQL states it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ASCII_LOWER, ASCII_UPPER, only, table
from .exact_dedup import exact_duplicates
from .filter_audit import filter_audit
from .license_scan import license_scan
from .line_dedup import DISTANCES, EXACT_CHARS, line_dedup
from .near_dedup import near_duplicates
from .packing import pack_documents
from .piece_codec import decode_ids, encode_texts
from .quality import quality_scores
from .secret_scan import BASE_KINDS, secrets
from .toxicity import toxicity
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, codebooks_sha256, compress, integer_vectors, label_errors
from .vector_search import quantised, top_k_inner_product
from .warc import MIN_REVISIT_BYTES, archive_and_read


def toxicity_labels(labels: DataFrame) -> DataFrame:
    """The labels as categories: junk (low quality) and toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"),
                      toxicity_labels(table(spark, sf_dir, "labels")), ["junk", "toxic"])
    return scored.select("doc_id", "p_junk", "p_toxic", "p_severe", "rejected", (~F.col("rejected")).alias("kept"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"))
    digest = encoded.select("id", (F.length("ids") / 4).cast("long").alias("n_ids"),
                            F.crc32("ids").alias("ids_crc32"), "ids")
    return decode_ids(digest).select(F.col("id").alias("doc_id"), "n_ids", "ids_crc32",
                                     F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"), repo_col=None)

    def spans(kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds)) if kinds else F.col("spans")

    def listed(chosen):
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        F.col("id").alias("doc_id"), *[F.size(spans([k])).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(spans(BASE_KINDS)).cast("binary"), 256).alias("base_sha256"), listed(spans(None)).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_example"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(only(table(spark, sf_dir, "embeddings"), vec_id="vec_id", vector="embedding"), "vector")
    return (top_k_inner_product(vectors, vectors.where("vec_id % 20 = 0"), k=20)
            .withColumnRenamed("id", "vec_id"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.size(F.split("text", "\n", -1)).cast("long")
    return line_dedup(docs, distance=DISTANCES, exact_chars=EXACT_CHARS).select(
        "doc_id", "removed_lines", F.when(F.col("text").isNotNull(), lines).alias("left_lines"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def packing_digest(packed: DataFrame) -> DataFrame:
    """The contract's columns of packed pieces."""
    return packed.select(
        F.col("id").alias("doc_id"), "start", (F.length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(pack_documents(table(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(col):
        return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1, F.lit(False))

    learn = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return quality_scores(table(spark, sf_dir, "documents"), learn).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    coded, codebooks = compress(vectors)
    return label_errors(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def _audit_sql() -> str:
    orders = " CROSS JOIN ".join(f"(SELECT unnest(range(5)) AS f{k}) t{k}" for k in range(5))
    differ = " AND ".join(f"f{i} <> f{j}" for i in range(5) for j in range(i))
    name = " || ".join(f"substr('ABCDE', f{j} + 1, 1)" for j in range(5))
    steps = " UNION ALL ".join(
        f"SELECT {name} AS filter_order, {k + 1} AS step, f{k} AS f, "
        f"{' + '.join([f'(1 << f{j})' for j in range(k)] or ['0'])} AS before FROM orders" for k in range(5))
    return f"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
        w AS (SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
                     min(doc_id) OVER (PARTITION BY body) AS first FROM t),
        m AS (SELECT doc_id, part,
                (len(words) < 200)::INTEGER
                + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
                + 4 * (100 * (length(body) - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(body))::INTEGER
                + 8 * regexp_matches(body, '[#$%&*|]')::INTEGER
                + 16 * coalesce(first < doc_id, false)::INTEGER AS failed FROM w),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
        d AS (SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good,
                     count(*) FILTER (WHERE toxic) AS toxic
              FROM m LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
        orders AS (SELECT * FROM {orders} WHERE {differ}),
        steps AS ({steps}),
        counted AS (
            SELECT part, filter_order, step, f,
                   sum(n) FILTER (WHERE failed & (before + (1 << f)) = 0) AS kept,
                   sum(n) FILTER (WHERE failed & before = 0 AND failed & (1 << f) > 0) AS removed,
                   sum(n) FILTER (WHERE failed & before > 0 AND failed & (1 << f) > 0) AS redundant,
                   sum(n) FILTER (WHERE failed = (1 << f)) AS unique_fails,
                   sum(good) FILTER (WHERE failed & before = 0 AND failed & (1 << f) > 0) AS good_lost,
                   sum(toxic) FILTER (WHERE failed & before = 0 AND failed & (1 << f) > 0) AS toxic_lost
            FROM d CROSS JOIN steps GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
               coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
               coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               sum(coalesce(removed, 0)) OVER (PARTITION BY part, f)::BIGINT AS shapley
        FROM counted"""


def _near_sql(words: int = 5, percent: int = 85) -> str:
    """Documents linked over all pairs that share a shingle, without bands or sketches."""
    return f"""
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'),
                                              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
                  ELSE [array_to_string(w[i : i + {words - 1}], ' ') for i in range(1, len(w) - {words - 2})] END) AS g FROM t),
        n AS (SELECT doc_id, len(g) AS n FROM s),
        u AS (SELECT doc_id, unnest(g) AS x FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
              GROUP BY 1, 2),
        links AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
                  WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
        reach AS (SELECT doc_id, doc_id AS other FROM t
                  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
        low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN low USING (doc_id)"""


def _codes_sql() -> str:
    """Full searches, round by round: no bounds."""
    ctes = [f"""v AS (SELECT vec_id, label, [floor({SCALE} * x::DOUBLE) for x in embedding] AS v FROM embeddings
                 WHERE embedding IS NOT NULL
                   AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
            f"""r AS (SELECT vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
                 FROM v CROSS JOIN (SELECT unnest(range({PARTS})) AS p))""",
            f"""c0 AS (SELECT p, e, x AS c FROM (
                 SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM r) WHERE e < {ENTRIES})"""]
    for k in range(ROUNDS + 1):
        ctes.append(f"""a{k} AS (SELECT vec_id, r.p, any_value(x) AS x, min(struct_pack(
                 d := list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), e := e)) AS best
                 FROM r JOIN c{k} c ON r.p = c.p GROUP BY vec_id, r.p)""")
        if k < ROUNDS:
            ctes.append(f"""n{k} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (
                 SELECT p, best.e AS e, i, floor(sum(x[i]) / count(*)) AS m
                 FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
            ctes.append(f"""c{k + 1} AS (SELECT o.p, o.e, coalesce(n.c, o.c) AS c
                 FROM c{k} o LEFT JOIN n{k} n ON o.p = n.p AND o.e = n.e)""")
    ctes.append(f"""h AS (SELECT sha256(string_agg(m::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (
                 SELECT p, e, unnest(range(len(c))) AS i, unnest(c) AS m FROM c{ROUNDS}))""")
    ctes.append(f"""o AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
                 sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY 1)""")
    return "WITH " + ",\n".join(ctes) + """
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM o JOIN v USING (vec_id) CROSS JOIN h"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity_chain, op2_minhash_near_dedup, op3_license_scan, op4_piece_codec, op5_exact_dedup,
        op6_secret_scan, op7_exact_top_k, op8_line_dedup, op9_vector_packing, op10_quality,
        op11_warc, op12_filter_audit, op13_vector_codes)}

ORACLE: dict[str, str] = {
    "op2_minhash_near_dedup": _near_sql(),
    "op5_exact_dedup": f"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}') AS body
                   FROM documents),
             g AS (SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
                          count(*) OVER (PARTITION BY body) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept,
               sha256(body) AS text_sha256 FROM g""",
    "op7_exact_top_k": """
        WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
                   AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_warc": f"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
                   FROM pages),
             g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
             m AS (SELECT *, payload_bytes >= {MIN_REVISIT_BYTES} AND first IS NOT NULL
                             AND page_id IS DISTINCT FROM first AS again FROM g)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to FROM m""",
    "op12_filter_audit": _audit_sql(),
    "op13_vector_codes": _codes_sql(),
}
