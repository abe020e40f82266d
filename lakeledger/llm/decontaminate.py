"""Documents that hold passages of a benchmark: SimHash windows of the items' sizes.

Column expressions, SQL operators and joins only. A window as long as an item
is laid wherever a document shares a word shingle with that item: aligned with
the shared shingle, and beginning at it. A window that begins with a shingle of
no item only gains by a move to the next shared one, so none is more similar
than all of these, whatever the order of the passage. Windows
and items get a SimHash; blocks of it, one more than the differing bits
allowed, find every item fingerprint within the radius; the similarity of the
weighted shingles decides.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import barrier, durable, words_of

WIDTH = 5
# Differing bits of 64 that a window and an item may have. At a similarity of
# 0.8 the expected number is 10 with a standard deviation of 3.
RADIUS = 15
# Rows (a hash and three small numbers, or an id) that may be broadcast.
BROADCAST_ROWS = 300_000


def _shift(function: str, value, by) -> Column:
    return F.call_function(function, value, by)


def shingles(words: str, width: Column) -> Column:
    """Word shingles joined by spaces, repeats included; of fewer words the whole sequence."""
    last = F.greatest(F.size(words) - width, F.lit(0))
    return F.when(
        F.size(words) > 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, width), " ")),
    ).otherwise(F.array().cast("array<string>"))


def simhash(parts: str) -> Column:
    """64-bit SimHash of an array of strings: a bit is set if more than half of the hashes have it."""
    hashes = F.transform(parts, lambda s: F.xxhash64(s))
    ones = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.aggregate(
            hashes, F.lit(0), lambda n, h: n + _shift("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int")
        ),
    )
    set_bits = F.filter(
        F.transform(ones, lambda n, b: F.when(n * 2 > F.size(parts), b)), lambda b: b.isNotNull()
    )
    return F.aggregate(
        set_bits, F.lit(0).cast("long"), lambda x, b: x.bitwiseOR(_shift("shiftleft", F.lit(1).cast("long"), b))
    )


def tagged(parts: str) -> Column:
    """Each string with its number among equal ones: multisets then intersect as sets."""
    return F.transform(parts, lambda s, i: F.concat(s, F.lit("\n"), (i - F.array_position(parts, s)).cast("string")))


def blocks(frame: DataFrame, fp: str, radius: int) -> DataFrame:
    """A row per block: of radius + 1 blocks, two fingerprints within the radius share one at least."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    cuts = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"),
        )
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    return frame.select("*", F.inline(F.array(*cuts)))


def _bounded(frame: DataFrame, rows: int) -> DataFrame:
    """With a broadcast hint if it is known to have few rows; joins are as right without it."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def items_of(benchmark: DataFrame, text: str, item_id: str) -> DataFrame:
    """Different item texts with their words; equal ones go by their least id, those without words go."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.lower(F.col(text)).alias("t"))
    rows = rows.select("item_id", words_of("t").alias("words")).where(F.size("words") > 0)
    rows = rows.groupBy("words").agg(F.min("item_id").alias("item_id"))
    rows = rows.withColumns({"n": F.size("words"), "width": F.least(F.size("words"), F.lit(WIDTH))})
    rows = barrier(rows, "parts", F.array_sort(shingles("words", F.col("width"))))
    return durable(rows.select("item_id", "words", "n", "width", "parts", simhash("parts").alias("item_fp")))


def _places(width: int) -> Column:
    """A hash for every ``width`` neighbours in the word hashes of ``hashes``; null where there are fewer."""
    return F.when(
        F.size("hashes") >= width,
        F.transform(
            F.sequence(F.lit(0), F.size("hashes") - width), lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(width)))
        ),
    )


def windows_of(docs: DataFrame, items: DataFrame, text: str, doc_id: str, similarity: float) -> DataFrame:
    """(doc_id, start, n, width, key, content): windows at shared shingles; key is the md5 of the content.

    Of those that begin at a shared shingle, the ones go that have too few
    shingles of items to reach the similarity.
    """
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # 1 to 5
    hashed = barrier(items, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    anchors = durable(
        functools.reduce(
            DataFrame.union,
            [hashed.where(F.col("width") == w).select("n", "width", F.posexplode(_places(w)).alias("at", "hash")) for w in widths],
        ).distinct()
        if widths
        else hashed.select("n", "width", F.lit(0).alias("at"), F.lit(0).cast("long").alias("hash"))
    )
    n_anchors = anchors.count()
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("t"))
    words = barrier(texts, "words", words_of("t")).drop("t")
    spots = None
    for width in widths:
        hashes = barrier(words, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
        found = (
            hashes.select("doc_id", F.size("hashes").alias("n_words"), F.posexplode_outer(_places(width)).alias("pos", "hash"))
            .join(_bounded(anchors.where(F.col("width") == width), n_anchors), "hash")
            .select(
                "doc_id", "n", "width", "n_words", "pos",
                F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n_words") - F.col("n"))).alias("start"),
            )
        )
        spots = found if spots is None else spots.union(found)
    if spots is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, start int, n int, width int, key string, content string"
        )
    spots = durable(spots.distinct())
    # A window of m shingles is similar to one of as many only if it shares so many of them.
    need = F.ceil((F.col("n") - F.col("width") + 1) * (2 * similarity / (1 + similarity)) - 1e-9).cast("int")
    last = F.col("n_words") - F.col("n")
    begins = F.transform(
        "places",
        lambda x, i: F.when(
            (x > last) | (F.get("places", i + F.greatest(need, F.lit(1)) - 1) <= x + F.col("n") - F.col("width")),
            F.greatest(F.lit(0), F.least(x, last)),
        ),
    )
    begun = spots.groupBy("doc_id", "n", "width", "n_words").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    begun = begun.select("doc_id", F.explode(F.array_distinct(begins)).alias("start"), "n", "width").where("start is not null")
    spots = durable(
        spots.select("doc_id", "start", "n", "width").union(begun).distinct()
        .groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "width")).alias("spots"))
    )
    ids = _bounded(spots.select(F.col("doc_id").alias("spot_doc")), spots.count())
    hit = words.join(ids, F.col("doc_id").eqNullSafe(F.col("spot_doc")), "left_semi")
    laid = (
        hit.join(spots.withColumnRenamed("doc_id", "spot_doc"), F.col("doc_id").eqNullSafe(F.col("spot_doc")))
        .select("doc_id", "words", F.explode("spots").alias("s"))
        .select(
            "doc_id", "s.start", "s.n", "s.width",
            F.array_join(F.slice("words", F.col("s.start") + 1, F.col("s.n")), " ").alias("content"),
        )
    )
    return durable(laid.select("doc_id", "start", "n", "width", F.md5("content").alias("key"), "content"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    similarity: float = 0.8,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, start, n_words, similarity.

    ``start`` is the word where the best window begins, ``similarity`` the
    weighted Jaccard similarity of its five-word shingles and the item's (of
    items with fewer words: the whole). Words are cut at ASCII white space and
    lower-cased. Items of equal words are one, under their least id. Null,
    empty and blank texts hold and are nothing. Rows of one id count as one
    document; a null id is an id like others. Other columns are not read. No
    documents or no items give no rows.
    """
    items = items_of(benchmark, item_text, item_id)
    windows = windows_of(docs, items, text, doc_id, similarity)
    # A passage that many documents hold is one content.
    contents = windows.select("n", "width", "key", "content").distinct()
    contents = contents.withColumn("words", F.split("content", " ", -1))
    contents = barrier(contents, "parts", F.array_sort(shingles("words", F.col("width"))))
    contents = durable(contents.select("n", "key", "parts", simhash("parts").alias("fp")))
    left = blocks(contents.select("n", "key", "fp"), "fp", radius)
    right = blocks(items.select("item_id", "n", "item_fp"), "item_fp", radius)
    near = (
        left.join(right, ["n", "block", "bits"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select("n", "key", "item_id")
        .distinct()
    )
    pairs = near.join(contents.select("n", "key", "parts"), ["n", "key"]).join(
        items.select("item_id", F.col("parts").alias("item_parts")), "item_id"
    )
    shared = F.size(F.array_intersect(tagged("parts"), tagged("item_parts")))
    scored = pairs.select(
        "n", "key", "item_id",
        (shared / (F.size("parts") + F.size("item_parts") - shared)).alias("similarity"),
    ).where(F.col("similarity") >= similarity)
    best = (
        windows.select("doc_id", "start", "n", "key").join(durable(scored), ["n", "key"])
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best"))
    )
    return best.select(
        F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id), (-F.col("best.back")).alias("start"),
        F.col("best.n").alias("n_words"), "best.similarity",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    held = leaks(docs, benchmark, text, doc_id).select(F.col(doc_id).alias("leak_doc")).distinct()
    kept = docs.select(F.struct("*").alias("kept"), F.col(doc_id).alias("kept_id"))
    return kept.join(held, F.col("kept_id").eqNullSafe(F.col("leak_doc")), "left_anti").select("kept.*")
