"""Corpus pipeline: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``docs`` is what the stage before kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import bpe, decontaminate, line_dedup, simhash_dedup, toxicity
from lakeledger.llm.common import barrier, durable_folder, ship, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below the limit. It learns from every labelled document of ``docs``."""
    ship(spark)
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return docs.where(toxicity.score(docs, model) < TOXIC_FROM).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three of them share; n_chars follows. Null texts stay null."""
    ship(spark)
    kept = line_dedup.dedup_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return kept.select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate class."""
    ship(spark)
    return simhash_dedup.keep_first(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document. Documents whose ids don't decode to their text would fail the write."""
    ship(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # Encoded once: without the barrier each use of the ids would encode again.
    rows = barrier(
        docs.select("doc_id", "lang", "source", "text"), "ids", bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)
    )
    exact = bpe.decode(F.col("ids"), ranks) == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    checked = F.when(exact, F.col("ids")).otherwise(F.raise_error(F.lit("token ids do not decode to the text")))
    return rows.select("doc_id", "lang", "source", checked.alias("ids")).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", tokenize),
]

# Neither the classifier nor the merges can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps lies in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{durable_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
