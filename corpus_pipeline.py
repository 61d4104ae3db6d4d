"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, as Parquet for the
next one; the last returns the packed pieces with their token ids (:func:`packing.sequences` joins
them).
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.llm import decontaminate, language_id, packing, pii, simhash
from punctuality.llm.tokens import Encoder
from punctuality.plans.durable import checkpoint_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the languages that the labelled ones teach.

    A document goes if its text has no letter (null, empty, digits) or if noise explains it far better
    than any mixture of the learned languages. Short texts with unknown words stay, very long ones are
    judged whole. Repeated rows fare alike; an empty table stays empty, and without any label all go.
    """
    model = language_id.fit(docs, "text", "lang", "doc_id")
    return language_id.kept(docs, model, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Rows that repeat an id are one document; rows without an id stay. Texts without words, null or
    empty, are copies of each other. Of very long texts all shingles count. An empty table stays empty.
    """
    return simhash.kept(docs, "doc_id", "text", shingle=3, radius=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none, very long ones are searched to their end, repeated rows fare alike,
    rows without an id are searched too. An empty table or benchmark takes nothing away.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, "text", benchmark, "item_id", "text")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in their texts, with the length of the new text.

    Null and empty texts stay as they are, very long ones are masked to their end, repeated rows and
    rows without an id like others. An empty table stays empty.
    """
    masked = pii.redact(docs, "text", pii.fit(docs, "doc_id", "text"))
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1024 tokens.

    A null text is empty and has its end token. Longer documents are cut into pieces, repeated rows and
    rows without an id are packed like others. An empty table gives no pieces.
    """
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    return packing.pack(docs, encoder, "doc_id", "text", 1024)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack),
]

# Models, fingerprints and tokens have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
