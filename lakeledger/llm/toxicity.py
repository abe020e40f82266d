"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is an n-gram of a text, hashed; it is present or not. Its value is
the log ratio of its smoothed frequencies in toxic and in other documents, and
logistic regression weighs those values.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS = (4, 5)
HASH_BITS = 20
# Documented bounds of the fit: labelled rows (those of lowest hash) and
# features (those that tell the classes apart best, by the standard errors that
# their log-count ratio is away from zero).
SAMPLE_ROWS = 20_000
FEATURES = 4_096
LEAST_ERRORS = 3.0
# Code points that are hashed at a time.
CHUNK = 1 << 20
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text; each run of other characters is one space, and so are both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.concatenate([[False], _letters()[codes], [False]])
    codes = np.where(letter, np.concatenate([[32], codes, [32]]), 32)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first space behind a letter
    return codes[keep].astype(np.uint64)


def features_of(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, in pieces; an n-gram may come more than once."""
    codes = letters_of(text)
    for at in range(0, len(codes), CHUNK):
        part = codes[at : at + CHUNK + max(LENGTHS) - 1]
        for n in LENGTHS:
            if len(part) >= n:
                h = np.zeros(len(part) - n + 1, np.uint64)
                for i in range(n):
                    h = (h ^ part[i : len(part) - n + 1 + i]) * _PRIMES[i]
                    h ^= h >> np.uint64(31)
                yield ((h * _PRIMES[0]) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


@dataclass
class Model:
    """Weight of each hashed n-gram (log-count ratio times regression weight) and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        known = [h[self.weights[h] != 0] for h in features_of(text)]
        present = np.unique(np.concatenate([*known, np.empty(0, np.int64)]))
        return float(1 / (1 + np.exp(-np.clip(self.weights[present].sum(dtype=float) + self.intercept, -500, 500))))


def _distinct(text: str) -> np.ndarray:
    return np.unique(np.concatenate([*features_of(text), np.empty(0, np.int64)]))


def fit(labelled: DataFrame, text: str = "text", label: str = "label") -> Model:
    """Fit on the rows of ``labelled`` (text, label 0 or 1); other labels and null ones are left out.

    The number of rows must be bounded by the caller (see ``training_rows``).
    Spark counts and selects; the driver gets the selected features and where
    they occur. Without rows of both classes every
    score is the share of toxic rows (0.5 without rows).
    """
    rows = labelled.where(F.col(label).isin(0, 1)).select(F.col(text).alias("t"), F.col(label).cast("int").alias("y"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[y][_distinct(t.as_py() or "")] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(seen[1][at]), pa.array(seen[0][at])],
            ["feature", "toxic", "other"],
        )

    # Texts are not read for this.
    totals = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n_toxic, n_other = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_other:
        share = min(max(n_toxic / max(1, n_toxic + n_other), 1e-6), 1 - 1e-6) if n_toxic + n_other else 0.5
        return Model(np.zeros(1 << HASH_BITS, np.float32), float(np.log(share / (1 - share))))
    p = (F.col("toxic") + 1) / F.lit(n_toxic + 2)
    q = (F.col("other") + 1) / F.lit(n_other + 2)
    error = F.sqrt((1 - p) / (F.col("toxic") + 1) + (1 - q) / (F.col("other") + 1))
    best = (
        rows.mapInArrow(count, "feature long, toxic long, other long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        # A feature of one document says nothing that carries over.
        .where("toxic + other > 1")
        .select("feature", F.log(p / q).alias("ratio"), (F.abs(F.log(p / q)) / error).alias("errors"))
        .where(F.col("errors") >= LEAST_ERRORS)
        .orderBy(F.desc("errors"), "feature")
        .limit(FEATURES)
        .toArrow()
    )
    if not best.num_rows:
        return Model(np.zeros(1 << HASH_BITS, np.float32), float(np.log(n_toxic / n_other)))
    chosen, scale = best.column("feature").to_numpy(), best.column("ratio").to_numpy()
    chosen, scale = chosen[np.argsort(chosen)], scale[np.argsort(chosen)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(0):
                own = _distinct(t.as_py() or "")
                at = np.minimum(np.searchsorted(chosen, own), len(chosen) - 1)
                found.append(at[chosen[at] == own].astype(np.int32))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.empty(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch.column(1), places], ["y", "places"])

    data = rows.mapInArrow(extract, "y int, places array<int>").toArrow().combine_chunks()
    y = data.column("y").to_numpy().astype(float)
    lists = data.column("places").combine_chunks()
    places = lists.flatten().to_numpy()
    counts = np.diff(lists.offsets.to_numpy())
    weights, intercept = regress(places, np.repeat(np.arange(len(y)), counts), y, scale)
    whole = np.zeros(1 << HASH_BITS, np.float32)
    whole[chosen] = weights * scale
    return Model(whole, intercept)


def regress(places: np.ndarray, rows: np.ndarray, y: np.ndarray, scale: np.ndarray, penalty: float = 1.0, steps: int = 300):
    """Logistic regression with an L2 penalty ; steps with momentum, scaled per feature."""
    value = scale[places]
    w, b = np.zeros(len(scale)), float(np.log(y.mean() / (1 - y.mean())))
    velocity, vb = np.zeros_like(w), 0.0
    memory, mb = np.zeros_like(w), 0.0
    for _ in range(steps):
        z = np.bincount(rows, value * w[places], len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        gradient = np.bincount(places, value * error[rows], len(scale)) + penalty * w
        # Steps scaled per feature, as their frequencies differ by orders of magnitude.
        memory += gradient**2
        mb += error.sum() ** 2
        velocity = 0.9 * velocity + 0.1 * gradient / np.sqrt(memory + 1e-12)
        vb = 0.9 * vb + 0.1 * error.sum() / np.sqrt(mb + 1e-12)
        w -= velocity
        b -= vb
    return w, b


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents, those whose ids have the lowest hashes.

    An id with several labels counts as toxic if one of them says so. The ids
    are bounded by ``rows`` and so may be broadcast: texts are not shuffled.
    """
    ids = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("label_id"))
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(rows)
    )
    texts = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    return texts.join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).select("text", "label")


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Toxicity of a text from 0 to 1; null is scored like the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of_texts(texts: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([own.score(t.as_py() or "") for t in texts], pa.float64())

    return of_texts(F.col(text))
