"""Lines that recur in several documents are dropped from all but one of them."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import SPACES, durable


def _key(line: str, least: int) -> bytes | None:
    bare = line.strip(SPACES)
    return hashlib.md5(bare.encode().lower(), usedforsecurity=False).digest() if len(bare) >= least else None


def line_keys(text: str, least: int) -> Column:
    """Distinct 16-byte hashes of a text's normalised lines of at least ``least`` code points."""

    @F.arrow_udf("array<binary>")
    def of_texts(texts: pa.Array) -> pa.Array:
        found = []
        for t in texts:
            keys = {_key(line, least) for line in (t.as_py() or "").split("\n")}
            keys.discard(None)
            found.append(list(keys))
        return pa.array(found, pa.list_(pa.binary()))

    return of_texts(F.col(text))


def without(text: Column, keys: Column, least: int) -> Column:
    """Struct of the text without the lines of ``keys`` and its numbers of lines."""

    @F.arrow_udf("kept string, n_lines long, n_dropped long")
    def of_texts(texts: pa.Array, drops: pa.Array) -> pa.Array:
        kept, n_lines, n_dropped = [], [], []
        for t, d in zip(texts, drops, strict=True):
            whole = t.as_py() or ""
            drop = set(d.as_py() or ())
            lines = whole.split("\n")
            stay = [x for x in lines if _key(x, least) not in drop] if drop else lines
            kept.append("\n".join(stay) if drop else whole)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            ["kept", "n_lines", "n_dropped"],
        )

    return of_texts(text, keys)


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 20, documents: int = 3
) -> DataFrame:
    """``docs`` with the columns kept_text, n_lines and n_dropped added.

    A line's key is the line stripped of ASCII white space with A-Z
    lower-cased. Keys of at least ``least`` code points in at least
    ``documents`` documents lose all their lines except in the largest id that
    holds them. Null and empty texts are one empty line and lose nothing. Rows
    of the same id are one document; a null id is a document smaller than all
    others. Columns kept_text, n_lines and n_dropped of the input are replaced.
    An empty table gives an empty result.
    """
    lines = docs.select(F.col(doc_id).alias("line_doc"), F.explode(line_keys(text, least)).alias("line_key"))
    # Once per document, which also spreads the lines that everybody has.
    pairs = durable(lines.distinct())
    common = durable(
        pairs.groupBy(F.col("line_key").alias("common_key"))
        .agg(F.count("*").alias("n"), F.max("line_doc").alias("keeper"))
        .where(F.col("n") >= documents)
        .select("common_key", "keeper")
    )
    losses = (
        pairs.join(common, F.col("line_key") == F.col("common_key"))
        .where(~F.col("line_doc").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("line_doc").alias("loss_doc"))
        .agg(F.collect_list("line_key").alias("loss_keys"))
    )
    names = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    # One struct, so that columns of any name can't clash with those of the join.
    whole = docs.select(F.struct(*names).alias("kept"), F.col(doc_id).alias("kept_doc"), F.col(text).alias("whole_text"))
    joined = whole.join(losses, F.col("kept_doc").eqNullSafe(F.col("loss_doc")), "left")
    return joined.select("kept", without(F.col("whole_text"), F.col("loss_keys"), least).alias("loss")).select(
        *(F.col("kept").getField(c).alias(c) for c in names),
        F.col("loss.kept").alias("kept_text"),
        F.col("loss.n_lines").alias("n_lines"),
        F.col("loss.n_dropped").alias("n_dropped"),
    )
