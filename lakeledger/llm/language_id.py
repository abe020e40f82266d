"""Language of a text by interpolated Kneser-Ney character models.

Spark counts the character 4-grams of each language over all training texts and
builds the models by grouping and joining: the lower orders follow from the
distinct n-grams, as Kneser-Ney counts contexts and not occurrences. For every
n-gram that any language has seen, its interpolated log-probability in each
language is worked out once. Up to a bound of bytes these tables are broadcast
and scoring is a search in sorted arrays of n-gram hashes; beyond it the texts'
n-grams are joined with the tables, with the same results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import durable
from lakeledger.llm.toxicity import letters_of

ORDER = 4
# Code points that are worked on at a time.
CHUNK = 1 << 20
# Bytes of a model up to which it is broadcast.
BROADCAST_BYTES = 64_000_000
# One training text in so many is held out to calibrate rejection, and the share of such texts to reject.
HELD_OUT = 10
REJECT_RATE = 0.01
UNKNOWN = "und"
# Hashes of a 4-gram and its shorter ends (k) and of their contexts (x).
KEYS = ["k4", "x4", "k3", "x3", "k2", "x2", "k1", "x1"]


def grams_of(text: str) -> Iterator[np.ndarray]:
    """The 4-grams of a text's letters and word bounds, a row of code points each, in pieces; nothing without letters."""
    codes = letters_of(text)
    if len(codes) < 3:
        return
    # Three spaces before the text, so that its first letter has a context.
    codes = np.concatenate([np.full(ORDER - 2, 32, np.uint64), codes])
    for at in range(0, len(codes) - ORDER + 1, CHUNK):
        yield np.lib.stride_tricks.sliding_window_view(codes[at : at + CHUNK + ORDER - 1], ORDER)


def hashed(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of every row of code points; each step is a bijection of the hash before it."""
    h = np.full(len(grams), grams.shape[1] * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for i in range(grams.shape[1]):
        h = (h ^ grams[:, i]) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x165667B19E3779F9)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _keys(grams: np.ndarray) -> list[np.ndarray]:
    """The columns KEYS of some 4-grams."""
    ends = [(hashed(grams[:, ORDER - n :]), hashed(grams[:, ORDER - n : ORDER - 1])) for n in range(ORDER, 0, -1)]
    return [k for pair in ends for k in pair]


def _counted(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different 4-grams and how often each occurs."""
    rows = np.concatenate(grams)
    number, _ = pd.factorize(hashed(rows))
    counts = np.bincount(number)
    first = np.empty(len(counts), np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    return rows[first], counts


def count_ngrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, held, KEYS, n) over all texts with a language; ``held`` marks those of the held-out texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for t, *own in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for grams in grams_of(t.as_py() or ""):
                    waiting.setdefault(tuple(own), []).append(grams)
                    size += len(grams)
                if size > 2 * CHUNK:
                    yield from emit(waiting)
                    waiting, size = {}, 0
        yield from emit(waiting)

    def emit(waiting: dict[tuple, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for (own, held), grams in waiting.items():
            found, n = _counted(grams)
            columns = [pa.array([own] * len(n)), pa.array([held] * len(n)), *map(pa.array, _keys(found)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "held", *KEYS, "n"])

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
        (F.pmod(F.xxhash64(F.col(text)), F.lit(HELD_OUT)) == 0).alias("held"),
    )
    kinds = ", ".join(f"{k} long" for k in KEYS)
    return rows.mapInArrow(count, f"lang string, held boolean, {kinds}, n long").groupBy("lang", "held", *KEYS).agg(F.sum("n").alias("n"))


@dataclass
class Tables:
    """A model as Spark tables: for each order, from the highest down, (key, logs) of n-grams and of their contexts.

    The latter are the weights that contexts give to the order below, for
    n-grams that no language knows.
    """

    languages: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]
    floor: float  # log-probability of a character that no language knows, below all orders


def build(counts: DataFrame) -> Tables:
    """Models of all languages of ``counts`` (lang, KEYS, n). The driver sees languages, discounts and the size of the alphabet.

    The discount of an order is the usual n1 / (n1 + 2 n2), kept off its bounds.
    """
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    each = range(len(languages))
    number = lambda values: F.array(*values) if languages else F.array().cast("array<long>")
    of = lambda name, i: F.get(name, F.lit(i))
    level = counts.groupBy(*KEYS).agg(number([F.sum(F.when(F.col("lang") == own, F.col("n")).otherwise(0)) for own in languages]).alias("c"))
    levels = []
    for n in range(ORDER, 0, -1):
        if n < ORDER:
            # How many different characters come before the shorter n-gram.
            level = level.groupBy(*KEYS[2 * (ORDER - n) :]).agg(number([F.count_if(of("c", i) > 0) for i in each]).alias("c"))
        level = durable(level)
        levels.append(level)
    alphabet = levels[-1].count() + 1
    below, grams, contexts = None, [], []
    for n, level in zip(range(1, ORDER + 1), reversed(levels), strict=True):
        seen = level.agg(F.lit(0), *(F.count_if(of("c", i) == k) for i in each for k in (1, 2))).first()[1:]
        cut = [min(max(a / (a + 2 * b), 0.1), 0.9) if a + b else 0.5 for a, b in zip(seen[::2], seen[1::2], strict=True)]
        around = level.groupBy(F.col(f"x{n}").alias("x")).agg(
            number([F.sum(of("c", i)) for i in each]).alias("total"), number([F.count_if(of("c", i) > 0) for i in each]).alias("kinds")
        )
        weight = [F.when(of("total", i) > 0, F.lit(cut[i]) * of("kinds", i) / of("total", i)).otherwise(1.0) for i in each]
        around = durable(around.select("x", "total", _doubles(weight).alias("w")))
        joined = level.join(around, F.col(f"x{n}") == F.col("x"))
        if below is not None:
            joined = joined.join(below.select(F.col("key").alias("under"), F.col("p").alias("q")), F.col(f"k{n - 1}") == F.col("under"))
        lower = [F.lit(1 / alphabet) if below is None else of("q", i) for i in each]
        share = [F.when(of("total", i) > 0, F.greatest(of("c", i) - cut[i], F.lit(0.0)) / of("total", i)).otherwise(0.0) for i in each]
        below = durable(joined.select(F.col(f"k{n}").alias("key"), _doubles([share[i] + of("w", i) * lower[i] for i in each]).alias("p")))
        grams.insert(0, below.select("key", F.transform("p", lambda x: F.log(x).cast("float")).alias("logs")))
        contexts.insert(0, around.select(F.col("x").alias("key"), F.transform("w", lambda x: F.log(x).cast("float")).alias("logs")))
    return Tables(languages, grams, contexts, -float(np.log(alphabet)))


def _doubles(values: list[Column]) -> Column:
    return F.array(*values).cast("array<double>")


def _add(total: np.ndarray, table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Take the rows of the table off ``total``; tells which of ``wanted`` have one."""
    keys, logs = table
    if not len(keys):
        return np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    at = at[hit]
    total -= np.bincount(at, minlength=len(keys)) @ logs if len(at) > len(keys) else logs[at].sum(axis=0, dtype=float)
    return hit


@dataclass
class Arrays:
    """A model as sorted arrays of n-gram hashes with a column of log-probabilities per language."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    languages: int
    floor: float

    def entropies(self, text: str) -> tuple[int, np.ndarray]:
        """Number of characters and the cross-entropy per character in each language."""
        total, n = np.zeros(self.languages), 0
        for grams in grams_of(text):
            n += len(grams)
            rest = grams
            for order, known, contexts in zip(range(ORDER, 0, -1), self.grams, self.contexts, strict=True):
                rest = rest[:, -order:]
                # An n-gram that no language knows goes to the next lower order.
                rest = rest[~_add(total, known, hashed(rest))]
                if not len(rest):
                    break
                _add(total, contexts, hashed(rest[:, :-1]))
            total -= len(rest) * self.floor
        return n, total / max(1, n)


def gathered(tables: Tables) -> Arrays | None:
    """The tables on the driver if they are within BROADCAST_BYTES."""
    rows = sum(t.count() for t in (*tables.grams, *tables.contexts))
    if rows * (8 + 4 * len(tables.languages)) > BROADCAST_BYTES:
        return None

    def arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = table.toArrow().combine_chunks()
        keys = found.column("key").to_numpy()
        logs = pa.chunked_array(found.column("logs")).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(keys)
        return keys[order], logs.astype(np.float32).reshape(len(keys), len(tables.languages))[order]

    return Arrays([arrays(t) for t in tables.grams], [arrays(t) for t in tables.contexts], len(tables.languages), tables.floor)


def entropies(docs: DataFrame, tables: Tables, arrays: Arrays | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in the struct ``row``, with n (characters) and h (cross-entropy per language)."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"))
    if arrays is not None:
        shared = docs.sparkSession.sparkContext.broadcast(arrays)

        @F.arrow_udf("n long, h array<double>")
        def of_texts(texts: pa.Array) -> pa.Array:
            found = [shared.value.entropies(t.as_py() or "") for t in texts]
            n, h = [n for n, _ in found], [h.tolist() for _, h in found]
            return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(h, pa.list_(pa.float64()))], ["n", "h"])

        return rows.select("row", of_texts("t").alias("e")).select("row", "e.n", "e.h")
    rows = durable(rows.withColumn("rid", F.monotonically_increasing_id()))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for grams in grams_of(t.as_py() or ""):
                    found, n = _counted([grams])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid] * len(n)), *map(pa.array, _keys(found)), pa.array(n)], ["rid", *KEYS, "n"]
                    )

    kinds = ", ".join(f"{k} long" for k in KEYS)
    rest = durable(rows.select("rid", "t").mapInArrow(own, f"rid long, {kinds}, n long"))
    lengths = rest.groupBy("rid").agg(F.sum("n").alias("n"))
    each = range(len(tables.languages))
    take = lambda part: part.select("rid", *(-F.col("n") * F.get("logs", F.lit(i)).cast("double") for i in each)).toDF("rid", *names)
    names = [f"h{i}" for i in each]
    parts = []
    for order, known, contexts in zip(range(ORDER, 0, -1), tables.grams, tables.contexts, strict=True):
        looked = durable(rest.join(known.withColumnRenamed("key", "known"), F.col(f"k{order}") == F.col("known"), "left"))
        parts.append(take(looked.where("known is not null")))
        rest = looked.where("known is null").drop("known", "logs")
        parts.append(take(rest.join(contexts, F.col(f"x{order}") == F.col("key"))))
    parts.append(rest.select("rid", *(-F.col("n") * F.lit(tables.floor) for _ in each)).toDF("rid", *names))
    total = parts[0]
    for part in parts[1:]:
        total = total.union(part)
    sums = total.groupBy(F.col("rid").alias("s_rid")).agg(*(F.sum(c).alias(c) for c in names)).join(lengths.withColumnRenamed("rid", "s_rid"), "s_rid")
    found = sums.select("s_rid", "n", _doubles([F.col(c) / F.col("n") for c in names]).alias("h"))
    joined = rows.join(found, F.col("rid") == F.col("s_rid"), "left")
    return joined.select("row", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("h", _doubles([F.lit(0.0) for _ in each])).alias("h"))


@dataclass
class Model:
    """Tables of all training texts, their arrays if they may be broadcast, and each language's limit of cross-entropy.

    A text of n characters is rejected beyond mean + margin / sqrt(n).
    """

    tables: Tables
    arrays: Arrays | None
    limits: dict[str, tuple[float, float]]

    @property
    def languages(self) -> list[str]:
        return self.tables.languages


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Models of every non-null language of ``docs``, from all its texts.

    Limits come from a second model without the held-out texts (a tenth, by
    hash of the text): of the held-out texts of a language, REJECT_RATE lie
    beyond its limit. A language without held-out texts rejects nothing. Texts
    are read once for the counts of both.
    """
    counts = durable(count_ngrams(docs, text, lang))
    tables = build(counts)
    part = build(counts.where("not held"))
    held = docs.where(F.col(lang).isNotNull() & (F.pmod(F.xxhash64(F.col(text)), F.lit(HELD_OUT)) == 0))
    held = held.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    at = F.array_position(F.array(*map(F.lit, part.languages)).cast("array<string>"), F.col("row.lang"))
    found = durable(
        entropies(held, part, gathered(part)).where(F.col("n") > 0)
        .select(F.col("row.lang").alias("lang"), "n", F.get("h", (at - 1).cast("int")).alias("h")).where("h is not null")
    )
    means = found.groupBy(F.col("lang").alias("m_lang")).agg((F.sum(F.col("h") * F.col("n")) / F.sum("n")).alias("mean"))
    spread = F.percentile_approx((F.col("h") - F.col("mean")) * F.sqrt("n"), 1 - REJECT_RATE, 10_000)
    limits = found.join(F.broadcast(means), F.col("lang") == F.col("m_lang")).groupBy("lang", "mean").agg(spread.alias("margin"))
    return Model(tables, gathered(tables), {r["lang"]: (r["mean"], r["margin"]) for r in limits.collect()})


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the column found added (one of that name is replaced): struct of lang, score, entropy and rejected.

    lang is the language of lowest cross-entropy per character, of equal ones
    the first by name; ``und``, with score 0 and rejected, for null texts and
    texts without letters or without a model. score is the best's posterior at
    four nats per character and root of the length. Texts of any length are
    scored whole; repeated rows and ids are scored each. An empty table gives
    an empty result.
    """
    names = [c for c in docs.columns if c != "found"]
    scored = entropies(docs, model.tables, model.arrays, text)
    row = [F.col("row").getField(c).alias(c) for c in names]
    if not model.languages:
        none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("entropy"), F.lit(True).alias("rejected"))
        return scored.select("row", none.alias("found")).select(*row, "found")
    best = F.array_min("h")
    at = F.array_position("h", best).cast("int") - 1
    languages = F.array(*map(F.lit, model.languages))
    bounds = [model.limits.get(own, (float("inf"), 0.0)) for own in model.languages]
    limit = F.get(F.array(*(F.lit(m) for m, _ in bounds)), at) + F.get(F.array(*(F.lit(s) for _, s in bounds)), at) / F.sqrt("n")
    odds = F.aggregate("h", F.lit(0.0), lambda x, v: x + F.exp(-F.least((v - best) * F.sqrt("n") * 4, F.lit(500.0))))
    letters = F.col("n") > 0
    return scored.select(
        "row",
        F.struct(
            F.when(letters, F.get(languages, at)).otherwise(UNKNOWN).alias("lang"),
            F.when(letters, 1 / odds).otherwise(0.0).alias("score"),
            F.when(letters, best).otherwise(0.0).alias("entropy"),
            F.when(letters, best > limit).otherwise(True).alias("rejected"),
        ).alias("found"),
    ).select(*row, "found")
