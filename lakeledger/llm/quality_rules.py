"""Quality rules as a ledger of failure bits and measurements, with policies as bit masks.

Every rule is evaluated once per document. A policy is a version and the rules
that count for it; what a policy keeps, and what it would keep without one of
its rules, is bit arithmetic on the ledger. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import barrier, words_of

WINDOW = 8

# Bit i of the ledger: rule i fails. Append only, so that stored ledgers stay readable.


def _rules() -> dict[str, Column]:
    c = F.col
    return {
        "few_words": c("n_words") < 20,
        "repeated_words": c("n_repeat_words") * 100 > c("n_words") * 30,
        "symbols": c("n_symbols") * 10 > c("n_words") * 3,
        "duplicate_lines": c("n_dup_lines") * 2 > c("n_lines"),
        "short_words": c("word_chars") < c("n_words") * 2,
        "long_words": c("word_chars") > c("n_words") * 20,
        "exclamations": c("n_exclaims") * 10 > c("n_words") * 3,
    }


RULE_NAMES = (
    "few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words", "exclamations",
)
# What the policies are made of; the base is what every policy rejects.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": RULE_NAMES,
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims")


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULE_NAMES.index(name) for name in rules)


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, the measurements and ``failed``, the bits of the rules it fails.

    Null, empty and blank texts have no words and so fail few_words. Repeated
    rows are repeated; null ids are kept; other columns are not read. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = barrier(rows, "words", words_of("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    rows = barrier(rows, "lines", lines)
    n = F.size("words")
    # Single elements are read in constant time, slices are not.
    rows = barrier(rows, "word_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    hashes = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*(F.get("word_hashes", i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_exclaims"),
        F.explode_outer(F.array(hashes)).alias("hashes"),
    )
    # Only texts with equal windows are sorted.
    ordered = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    rows = barrier(rows, "ordered", ordered)
    twin = lambda x, j: F.coalesce(F.get("ordered", j)["h"] == x["h"], F.lit(False))
    places = F.sort_array(
        F.transform(F.filter("ordered", lambda x, j: twin(x, j - 1) | twin(x, j + 1)), lambda x: x["i"])
    )
    rows = barrier(rows, "places", places)
    covered = F.aggregate(
        F.transform(
            "places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("places", j + 1) - p, F.lit(WINDOW)))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    rows = rows.withColumn("n_repeat_words", covered)
    bits = F.lit(0).cast("long")
    for i, (name, fails) in enumerate(_rules().items()):
        assert name == RULE_NAMES[i]
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return rows.select(F.col("doc_id").alias(doc_id), *MEASURES, bits.alias("failed"))


def passes(policy: str) -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents failing it, those failing only it, and those kept without it.

    One aggregate over the ledger by failure pattern (at most two to the number
    of rules), then arithmetic on the patterns.
    """
    own = mask(POLICIES[policy])
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(own)).alias("pattern")).agg(F.count("*").alias("n"))
    kept = F.sum(F.when(F.col("pattern") == 0, F.col("n")).otherwise(0))
    cells = []
    for name in POLICIES[policy]:
        bit = mask((name,))
        fails = F.sum(F.when(F.col("pattern").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0))
        alone = F.sum(F.when(F.col("pattern") == bit, F.col("n")).otherwise(0))
        cells.append(
            F.struct(
                F.lit(name).alias("rule"), F.coalesce(fails, F.lit(0)).alias("n_failed"),
                F.coalesce(alone, F.lit(0)).alias("n_failed_alone"), F.coalesce(kept + alone, F.lit(0)).alias("n_kept_without"),
            )
        )
    return patterns.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
