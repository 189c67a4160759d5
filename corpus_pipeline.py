"""Documents to packed training sequences, in stages that each call one operator of portolan.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import language, packing, secret_scan, simhash, site_quality
from portolan.sources.scratch import new_scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text goes if no language holds more than this share of its evidence.
LEAST_SHARE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without letters go.

    Repeated rows stay or go alike; an empty table gives none.
    """
    found = language.detect_languages(docs, keep=list(COLUMNS))
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, keeps.

    Repeated rows stay or go alike; an empty table gives none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return site_quality.classify_quality(docs, labels, keep=COLUMNS).filter("kept").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Of rows alike in id and fingerprint one stays, the first by text; an id on texts of
    several groups may stay for each of them. Rows without an id cannot be named and stay.
    Repeated rows are one; an empty table gives none.
    """
    return simhash.one_of_each_group(docs.select(*COLUMNS), shingle=3, bits=2)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets blotted out of the texts and n_chars as it then is."""
    found = secret_scan.find_secrets(docs.select(*COLUMNS))
    clean = secret_scan.redacted(F.col("text"), F.col("spans"))
    touched = F.size("spans") > 0
    return found.withColumn("text", clean).select(
        "doc_id", "text", "lang", "source",
        F.when(touched, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens and their places in sequences.

    Null texts are one token, repeated rows have their own places; no documents, no pieces.
    """
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"))
    return packing.pack(narrow, capacity=2048)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Fitted models, fingerprints and token ids are beyond SQL; tests/llm hold the stages
# against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a stored table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
