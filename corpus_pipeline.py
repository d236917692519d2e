"""The corpus pipeline: language, repeated lines, near-duplicates, benchmark passages, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.llm import decontaminate, langid, line_dedup, near_dedup, packing
from collatio.llm.queries import tokenizer_path
from collatio.llm.shared import load, shared_folder, small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts whose language stays ambiguous go; lang keeps what the source says.

    Documents none of which has a language to learn from are an error, since all would be rejected; none at all are none.
    """
    small_batches(spark)
    model = langid.train(docs)
    if model is None and not docs.isEmpty():
        raise ValueError("no document outside the held-out fold has a text and a language to learn from")
    scored = langid.identify(docs.select(*COLUMNS), model, prefix="_")
    return scored.where((F.col("_lang_pred") != langid.UNKNOWN) & ~F.col("_ambiguous")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more go, and so do documents of which nothing else is left."""
    cleaned = line_dedup.drop_repeated_lines(docs.select(*COLUMNS))
    left = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share 0.8 of their five-word shingles the one with the smallest id stays."""
    return near_dedup.keep_one(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more lies in benchmark windows go."""
    return decontaminate.keep_clean(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed in sequences of 1024 tokens. Executors that ran the other stages have less memory left, so workers take smaller steps."""
    return packing.pack(docs, tokenizer_path(), chunk_bytes=1_000_000, remembered=100_000)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

#: Learned language scores and MinHash have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the cluster's shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
