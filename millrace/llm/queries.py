"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    licenses,
    pii,
    ranked_search,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
    vectors,
)

#: Stands in for a secret that a real run gets from its deployment.
PSEUDONYM_KEY = "not a secret"

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_passages(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), words=3, bits=3).drop("h", "component")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(_documents(spark, sf_dir), benchmark).drop("h")


def op5_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.bounded_ring(_documents(spark, sf_dir), shards=24, points=128)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_documents(spark, sf_dir), VOCABULARY, public_tokenizers.PATTERN)
    both = bpe.decode(encoded, VOCABULARY)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, threshold=0.7)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(_documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(_documents(spark, sf_dir), PSEUDONYM_KEY, kinds_col="kinds")
    return out.select("doc_id", F.size("kinds").cast("long").alias("n_values"), "kinds", "text")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(_documents(spark, sf_dir).select("doc_id", "text"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS]
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *counts[:3], F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"), counts[3])


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), every=50, positives=5, negatives=3)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_decontamination": op4_decontamination,
    "op5_bounded_ring": op5_bounded_ring,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_pii_pseudonyms": op10_pii_pseudonyms,
    "op11_secret_scan": op11_secret_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT a.id AS anchor_id, r.id, a.label = r.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM rows a JOIN rows r ON a.id % 50 = 0 AND a.id <> r.id
        ), near AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT n.anchor_id, n.positive_id,
               (row_number() OVER (PARTITION BY n.anchor_id, n.positive_id ORDER BY s.score DESC, s.id))::INT AS rank,
               s.id AS negative_id, n.positive_score, s.score AS negative_score
        FROM near n JOIN scored s ON s.anchor_id = n.anchor_id AND NOT s.alike
         AND 50 * n.positive_score <= 100 * s.score AND 100 * s.score <= 95 * n.positive_score
        QUALIFY row_number() OVER (PARTITION BY n.anchor_id, n.positive_id ORDER BY s.score DESC, s.id) <= 3
    """,
    "op13_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), q AS (
            SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
            FROM benchmark
        ), total AS (
            SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_words FROM d WHERE len(terms) > 0
        ), postings AS (
            SELECT r, doc_id, term, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
            FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY r, doc_id, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM postings, total GROUP BY term, n_docs
        ), scored AS (
            SELECT q, item_id, r, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words))))::BIGINT AS score
            FROM (SELECT q, item_id, unnest(terms) AS term FROM q) JOIN postings USING (term) JOIN weights USING (term), total
            GROUP BY q, item_id, r, doc_id
        )
        SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r))::INT AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) <= 10
    """,
}
