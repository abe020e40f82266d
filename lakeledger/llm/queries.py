"""Queries over the given tables, one per operator, and the pipeline."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import bpe, decontaminate, html_text, language_id, line_dedup, merkle_manifest, passage_dedup, quality_rules, shard_shuffle, simhash_dedup, token_alignment, toxicity, vector_topk
from lakeledger.llm import oracles
from lakeledger.llm.common import barrier, fold, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_line_dedup": oracles.LINE_DEDUP,
    "op5_quality_rules": oracles.QUALITY_RULES,
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
    "op13_exact_top_k_search": oracles.EXACT_TOP_K,
}

TOXIC_FROM = 0.3
SHARDS = 40


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query; workers are told where its package is first."""

    @functools.wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


@query
def op1_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and what they decode to, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Encoded once: without the barrier each use of the ids would encode again.
    encoded = barrier(docs, "ids", bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.id_bytes(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the labelled ones outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 4) == 2
    model = toxicity.fit(toxicity.training_rows(docs, labels.where(~held_out)))
    scored = docs.select("doc_id", "text").withColumn("score", toxicity.score(docs, model))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters that three documents share stay in the last one only."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, and where."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of every document and the verdict of policy v1."""
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"),
        quality_rules.passes("v1").alias("kept"),
        "failed",
    )


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a uniform shuffle into 40 shards."""
    docs = table(spark, sf_dir, "documents")
    octets = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id", (F.octet_length(octets) + F.lit(16)).cast("long").alias("size"), F.crc32(octets).alias("text_crc32")
    )
    placed = shard_shuffle.shuffle_into_shards(narrow, SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract_pages(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share."""
    return passage_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by models of the texts outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    model = language_id.fit(docs.where(~held_out))
    return language_id.identify(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.entropy").alias("entropy"),
        F.col("found.rejected").alias("rejected"),
    )


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf of the manifest, its proof, and whether it holds after tampering."""
    docs = table(spark, sf_dir, "documents")
    digest = merkle_manifest.row_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    tampered = merkle_manifest.row_digest(
        [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [F.replace("text", F.lit("\n"), F.lit(""))]
    )
    leaves = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("key"),
        digest.alias("digest"),
        F.when(fold("doc_id", 2) == 0, tampered).alias("changed"),
    )
    found = merkle_manifest.manifest(leaves)
    text = lambda name: F.lower(F.hex(name))
    return found.select(
        F.col("key").alias("doc_id"),
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        F.sha2(text("siblings").cast("binary"), 256).alias("proof_sha256"),
        text("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other in every document."""
    return token_alignment.alignment_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def op13_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of highest inner product of every row whose id is divisible by 20."""
    return vector_topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
