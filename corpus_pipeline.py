"""The corpus pipeline: five operators, each on all that the one before it kept.

    run(spark, sf_dir)

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next stage's docs. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm import alike, bpe, langid, mixing, suffixes
from brisa.llm.text import settled, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with the predicted one in ``lang``, also where
    another was given; texts that are null or have no letter go. Profiles are learnt from
    the documents that have a language."""
    settled(spark)
    prototypes = langid.fit(docs)
    found = langid.identify(docs, prototypes).where(F.col("lang_pred") != langid.UNDETERMINED)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Texts
    are linked from a Jaccard similarity of 0.8 of their distinct five-word shingles on."""
    settled(spark)
    return alike.leaders(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of long strings that also begin elsewhere. Of a
    character that was cut in part nothing stays; nobody loses their row."""
    settled(spark)
    found = suffixes.without_repeats(docs, as_text=True)
    found = found.withColumn("text", F.when(F.col("removed_bytes") == 0, F.col("text")).otherwise(F.col("kept")))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them, a row for every time it takes one."""
    settled(spark)
    return mixing.mixed_texts(docs).select(*COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as count and digests, and of what they decode to."""
    settled(spark)
    ranks = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # Workers also hold what the other stages left: they remember fewer words and handle
    # fewer texts at once here.
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, cached=20_000, texts=256)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("tokenized", tokenized),
]

#: SimHash and the language profiles cannot be said in SQL; tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
