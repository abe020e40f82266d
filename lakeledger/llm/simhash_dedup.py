"""SimHash near-duplicate classes through vantage-point trees over Hamming distance.

Fingerprints are reduced to distinct values first. A tree of vantage points
cuts their space into leaves. At a node with vantage point v and threshold t, a
fingerprint x at distance d goes inside when d <= t and outside when d > t. Two
fingerprints at most r apart differ by at most r in d, so a pair that the node
separates has its outer end at t < d <= t + r: those fingerprints visit the
inner leaves too, and each pair within r meets in a leaf at least once. Leaves
are searched exactly.

No vantage point divides a cluster of near copies. Two bits apart means one bit
from a common value: there every fingerprint goes to its 64 neighbours and to
itself, and those that meet are links. At most 65 can meet, however large the
cluster, so such leaves are spread over tasks by neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import durable
from lakeledger.llm.components import components

# Distinct fingerprints that a leaf should hold, and how many sampled ones fit
# the tree: a tree has at most TREE_SAMPLE / PER_LEAF leaves.
LEAF_ROWS = 1500
PER_LEAF = 24
TREE_SAMPLE = 200_000
# Below so many fingerprints all pairs of a block are compared.
BLOCK = 384
# From so many on an undivided block of a leaf is searched by neighbours.
NEIGHBOURS_FROM = 4096
SEED = 42

_FLIPS = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words (all words if there are fewer); none without words."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - width + 1)


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set when more than half of the hashes have it; as a signed 64-bit number."""
    octets = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(text: str, width: int = 3) -> Column:
    """SimHash of the word shingles of a text column, A-Z lower-cased; zero without words."""

    @F.arrow_udf("long")
    def of_texts(texts: pa.Array) -> pa.Array:
        return pa.array(
            (simhash(shingle_hashes((t.as_py() or "").encode().lower(), width)) for t in texts), pa.int64()
        )

    return of_texts(F.col(text))


# --- the tree -------------------------------------------------------------


def grow(sample: np.ndarray, leaves: int, radius: int, seed: int = SEED) -> tuple[list[tuple[int, int, int, int]], set[int]]:
    """Nodes (vantage point, threshold, inner child, outer child) and the leaves that no vantage point divides.

    Leaf k is child -k - 1.
    """
    rng = np.random.default_rng(seed)
    nodes: list = []
    per_leaf = max(2, len(sample) // max(1, leaves))
    free = [0]
    whole: set[int] = set()

    def leaf() -> int:
        free[0] += 1
        return -free[0]

    def split(points: np.ndarray) -> int:
        large = len(points) >= 2 * per_leaf
        cut = choose(points, radius, rng) if large else None
        if cut is None:
            if large:
                whole.add(free[0])
            return leaf()
        vantage, threshold, distance = cut
        at = len(nodes)
        nodes.append(None)
        inner = split(points[distance <= threshold])
        outer = split(points[distance > threshold])
        nodes[at] = (int(vantage), int(threshold), inner, outer)
        return at

    split(sample)
    return nodes, whole


def choose(points: np.ndarray, radius: int, rng: np.random.Generator, tries: int = 12):
    """The cut, of some tried, that sends the fewest points to both sides; None if none divides."""
    best, found = 0.8, None
    for vantage in rng.choice(points, min(tries, len(points)), replace=False):
        distance = np.bitwise_count(points ^ vantage).astype(np.int64)
        below = np.cumsum(np.bincount(distance, minlength=65 + radius)) / len(points)
        for threshold in np.flatnonzero((below[:65] >= 0.25) & (below[:65] <= 0.75)):
            cost = max(below[min(64, threshold + radius)], 1 - below[threshold])
            if cost < best:
                best, found = cost, (vantage, threshold, distance)
    return found


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], radius: int):
    """Yield (leaf, positions of the points that visit it)."""
    stack = [(0 if nodes else -1, np.arange(len(points)))]
    while stack:
        at, rows = stack.pop()
        if at < 0:
            if len(rows):
                yield -at - 1, rows
            continue
        vantage, threshold, inner, outer = nodes[at]
        distance = np.bitwise_count(points[rows] ^ np.uint64(vantage))
        stack.append((inner, rows[distance <= threshold + radius]))
        stack.append((outer, rows[distance > threshold]))


def close_pairs(points: np.ndarray, radius: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of position pairs within ``radius``, by the same cuts down to small blocks."""
    stack = [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        cut = choose(points[rows], radius, rng, 6) if len(rows) > BLOCK else None
        if cut is not None:
            _, threshold, distance = cut
            stack += [rows[distance <= threshold + radius], rows[distance > threshold]]
            continue
        if radius == 2 and len(rows) >= NEIGHBOURS_FROM:
            yield from ((rows[a], rows[b]) for a, b in neighbour_pairs(points[rows]))
            continue
        for at in range(0, len(rows), BLOCK):
            part = rows[at : at + BLOCK]
            left, right = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[rows[at:]]) <= radius)
            yield part[left], rows[at:][right]


def neighbour_pairs(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of position pairs at most two bits apart among distinct points: those with a common neighbour."""
    values = (points[:, None] ^ _FLIPS).ravel()
    order = np.argsort(values, kind="stable")
    values, owner = values[order], order // len(_FLIPS)
    for step in range(1, len(_FLIPS)):
        at = np.flatnonzero(values[step:] == values[:-step])
        if not len(at):
            return
        yield owner[at], owner[at + step]


def forest(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each position the smallest position it is connected with."""
    root = np.arange(size)
    for left, right in pairs:
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    return root


# --- Spark ----------------------------------------------------------------


def fit_tree(prints: DataFrame, radius: int) -> tuple[list[tuple[int, int, int, int]], set[int]]:
    """A tree (see ``grow``) for distinct fingerprints ``fp``, fitted on at most TREE_SAMPLE of them (lowest hashes)."""
    leaves = min(TREE_SAMPLE // PER_LEAF, max(1, prints.count() // (LEAF_ROWS // 2)))
    sample = prints.orderBy(F.xxhash64("fp"), "fp").limit(leaves * PER_LEAF).select("fp").toArrow()
    points = sample.column("fp").to_numpy().view(np.uint64)
    return grow(points, leaves, radius)


def neighbour_links(prints: DataFrame, all_pairs: bool) -> DataFrame:
    """Pairs (a, b) of fingerprints ``fp`` at most two bits apart, through the values one bit from both.

    By default those that meet at a value are linked with the least of them.
    """
    flips = F.array(F.lit(0).cast("long"), *(F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(i)) for i in range(64)))
    met = (
        prints.select("fp", F.explode(flips).alias("flip"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
        .agg(F.array_sort(F.collect_set("fp")).alias("fps"))  # 65 at most
        .where(F.size("fps") > 1)
    )
    if not all_pairs:
        return met.select(F.get("fps", F.lit(0)).alias("a"), F.explode(F.slice("fps", F.lit(2), F.size("fps"))).alias("b")).distinct()
    pairs = F.flatten(
        F.transform("fps", lambda x, i: F.transform(F.slice("fps", i + 2, F.size("fps")), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    )
    return met.select(F.inline(pairs)).distinct()


def links(prints: DataFrame, radius: int, all_pairs: bool = False) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` at most ``radius`` bits apart.

    By default each leaf gives the edges that connect what it has found
    connected, which is all that classes need and never more than its rows;
    ``all_pairs`` gives every pair within the radius once. At a radius of two
    bits, leaves that no vantage point divides are searched by neighbours
    (``neighbour_links``), with the same links; at others by all pairs of the
    leaf in one task.
    """
    nodes, whole = fit_tree(prints, radius)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for leaf, rows in route(points, nodes, radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), leaf, np.int64)), pa.array(points[rows].view(np.int64))],
                    ["leaf", "fp"],
                )

    def search(leaf: pa.Table) -> pa.Table:
        fp = np.unique(leaf.column("fp").to_numpy())
        points = fp.view(np.uint64)
        found = close_pairs(points, radius, np.random.default_rng(SEED))
        if all_pairs:
            seen = [np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b] for a, b in found]
            a, b = np.unique(np.concatenate([*seen, np.empty((2, 0), np.int64)], axis=1), axis=1)
        else:
            root = forest(len(fp), found)
            a = np.flatnonzero(root != np.arange(len(fp)))
            b = root[a]
        return pa.table({"a": fp[a], "b": fp[b]})

    visits = prints.select("fp").mapInArrow(visit, "leaf long, fp long")
    if whole and radius == 2:
        visits = durable(visits)
        hot = F.col("leaf").isin(sorted(whole))
        edges = visits.where(~hot).groupBy("leaf").applyInArrow(search, "a long, b long")
        edges = edges.union(neighbour_links(visits.where(hot).select("fp").distinct(), all_pairs))
    else:
        edges = visits.groupBy("leaf").applyInArrow(search, "a long, b long")
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = 2) -> DataFrame:
    """One row per document: id, ``fp`` (SimHash as a long) and ``component_id``.

    component_id is the smallest id reachable over links of at most ``radius``
    differing bits, the document's own included. Null and blank texts have the
    fingerprint zero and link like any other; null ids never name a class
    (null where a class has no other id); repeated rows stay repeated; other
    columns are not read. An empty table gives an empty result.
    """
    base = durable(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("fp")))
    prints = durable(base.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(prints, radius))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = durable(rooted.join(least, "root").select(F.col("fp").alias("class_fp"), "component_id"))
    return base.join(classes, F.col("fp") == F.col("class_fp")).select(
        F.col("doc_id").alias(doc_id), "fp", "component_id"
    )


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = 2) -> DataFrame:
    """The documents, all columns, whose id names their class: one of each group of near duplicates.

    Documents without an id are kept, as no class can be named by them;
    repeated rows of one id are all kept or all dropped.
    """
    found = near_duplicates(docs, text, doc_id, radius)
    gone = found.where(F.col(doc_id) != F.col("component_id")).select(F.col(doc_id).alias("gone_id")).distinct()
    kept = docs.select(F.struct("*").alias("kept"), F.col(doc_id).alias("kept_id"))
    return kept.join(gone, F.col("kept_id") == F.col("gone_id"), "left_anti").select("kept.*")
