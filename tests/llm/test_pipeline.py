"""The pipeline: each stage against a plain version on what the stage before kept."""

from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lakeledger.llm import bpe
from tests.llm import helpers as h


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{h.SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, h.SF).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        if name != "byte_level_bpe":
            assert docs.columns == before.columns
        kept[name] = [(r["doc_id"], r["text"]) for r in docs.collect()] if "text" in docs.columns else docs.collect()
    toxic = dict(h.rows_of("labels", "doc_id, toxic"))
    all_docs = dict(h.documents())
    gone = set(all_docs) - {i for i, _ in kept["toxicity"]}
    assert sum(toxic.get(i, 0) for i in gone) >= 0.9 * sum(toxic.values()) and len(gone) < 0.2 * len(all_docs)
    lines = {i: t for i, _, _, t in h.without_lines(kept["toxicity"])}
    assert dict(kept["line_dedup"]) == lines
    near = {i: t for (i, _, c), (_, t) in zip(h.near_classes(kept["line_dedup"]), kept["line_dedup"], strict=True) if i == c}
    assert dict(kept["simhash_near_dedup"]) == near
    held = {i for i, _ in h.leaks(kept["simhash_near_dedup"], h.rows_of("benchmark", "item_id, text"))}
    clean = {i: t for i, t in near.items() if i not in held}
    assert dict(kept["benchmark_decontamination"]) == clean
    ranks = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")).split(b"\n")).rank
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {r["doc_id"]: np.array(r["ids"]).tolist() for r in kept["byte_level_bpe"]}
    assert ids == {i: own.encode_ordinary(t or "") for i, t in clean.items()}


def test_stages_on_odd_documents(spark, folder):
    """Nulls, empty and very long texts, repeated rows and ids, null ids, columns named like those of the stages."""
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "web", None if t is None else len(t)) for k, (i, t) in enumerate(h.ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["kept", "kept_id", "kept_doc", "gone_id", "leak_doc", "loss_keys", "loss_doc", "whole_text", "label", "label_id", "ids", "component_id", "fp"]
    for name, stage in corpus_pipeline.STAGES:
        crowded = docs.select("*", *(F.lit("x").alias(c) for c in names))
        stage(spark, crowded, h.SF).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        if name != "byte_level_bpe":
            assert docs.columns == before.columns
        if name == "line_dedup":
            had = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = Counter((i, t if old is not None else None) for (i, _, _, t), (_, old) in zip(h.without_lines(had), had, strict=True))
            assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == want
    assert docs.count() > 0


def test_run_and_empty(spark, folder):
    assert corpus_pipeline.run(spark, h.SF).count() > 0
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{h.SF}/{table}.parquet").where("false").write.parquet(f"{folder}/{table}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
