"""Clean a corpus of documents in five stages, each written and read again before the next.

Toxic documents go, then all but one of each group of near duplicates, then documents that hold a benchmark
item; personal values are replaced; and what is left is encoded and decoded again. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, pii, simhash, toxicity
from millrace.llm.queries import PSEUDONYM_KEY, VOCABULARY
from millrace.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the machine is fitted on labelled documents of this stage's input."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model, threshold=0.7)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link at 3 or fewer bits: that of the least id."""
    return simhash.keep_one(docs, words=3, bits=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, as it is or with other numbers, names and units."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal values, and the length in letters of the text as it then is."""
    out = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    both = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("pii", pseudonymous),
    ("byte_bpe", encoded),
]

#: The stages score, hash and encode in ways that SQL has no words for; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
