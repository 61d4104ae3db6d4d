"""The registered queries of the text operators, with their production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.llm import (
    conversations, decontaminate, language_id, packing, pii, quality, range_join, ranked_search, secrets, simhash,
    substring, token_files, topk,
)
from punctuality.llm.common import remainder
from punctuality.llm.tokens import Encoder
from punctuality.plans.durable import checkpoint_folder

END = 2  # the id after each document


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held_out), "text", "lang", "doc_id")
    found = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, "text")
    return found.select("doc_id", "held_out", "lang_pred", "score", "n_languages")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", shingle=3, radius=3)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.leaks(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", benchmark, "item_id", "text")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", window=50)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), END)
    return packing.pack(documents(spark, sf_dir, "doc_id", "text"), encoder, "doc_id", "text", 1024).drop("ids")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", k=5, every=50)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A ledger of its own, so that a run scans every document's blob; given the same path again, it would scan none.
    ledger = f"{checkpoint_folder(spark)}/ledger-{uuid.uuid4().hex}"
    found = secrets.findings_by_ledger(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", ledger)
    return found.withColumnRenamed("path", "doc_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"), END)
    token_files.write(documents(spark, sf_dir, "doc_id", "text"), encoder, "doc_id", "text", path)
    return token_files.read(spark, path)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(docs, labels.filter(~held_out), "doc_id", "text", "quality")
    found = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model, "text")
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return pii.scan(docs, "text", pii.fit(docs, "doc_id", "text")).drop("text")


def op11_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 0.95)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repaired_after_damage(rows, "conv_id", "turn", "role", "text")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked_search.search(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", items, "item_id", "text", k=20)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_exact_topk": op6_exact_topk,
    "op7_secret_scans": op7_secret_scans,
    "op8_token_files": op8_token_files,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_range_join": op11_range_join,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ranked_search": op13_ranked_search,
}

TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
        CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.95
), reached(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), named AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, n.component_id, e.vec_id = n.component_id AS kept
FROM embeddings e JOIN named n USING (vec_id) LEFT JOIN counted c USING (vec_id)
"""

RANKED_SQL = r"""
WITH found AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), docs AS (SELECT doc_id, terms, len(terms) AS n FROM found WHERE len(terms) > 0),
total AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM docs),
asked AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)
    ) GROUP BY ALL
), held AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighted AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, total GROUP BY term
), scored AS (
    SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + CAST((25 * n * n_docs) // n_terms AS BIGINT)))))
        AS BIGINT) AS score
    FROM asked JOIN weighted USING (term) JOIN held USING (term), total GROUP BY ALL
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _secret_sql() -> str:
    """The scan in SQL: places from the lengths of gaps and matches."""
    parts = []
    for i, rule in enumerate(secrets.RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(f"""
        SELECT doc_id, text, '{rule.kind}' AS kind, {i} AS place, unnest(range(1, len(whole) + 1)) AS i, whole, kept, gaps
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{p}') AS whole,
                     regexp_extract_all(text, '{p}', {rule.group}) AS kept, string_split_regex(text, '{p}') AS gaps
              FROM docs WHERE regexp_matches(text, '{p}'))""")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(parts)}),
spans AS (
    SELECT doc_id, kind, place, kept[i] AS kept, length(whole[i]) AS n,
           CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM matches
),
good AS (SELECT *, kind || ':' || start || ':' || (start + n) AS span FROM spans
         WHERE length(kept) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 ELSE 32 END),
found AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.RULES)},
           string_agg(span, ',' ORDER BY start, place) AS spans
    FROM good GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES)},
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, upper(sha256(d.text)) AS blob
FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id
"""


ORACLES: dict[str, str] = {
    "op6_exact_topk": TOP_K_SQL,
    "op7_secret_scans": _secret_sql(),
    "op11_range_join": NEAR_VECTORS_SQL,
    "op13_ranked_search": RANKED_SQL,
}
