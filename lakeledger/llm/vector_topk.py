"""Exact top-k by inner product through segment means and deviations, coarse to fine.

A vector is cut into segments. With the means m and deviations s of the
segments, of length n, of two vectors, the sum of
n * ((m - m')**2 + (s - s')**2) is a lower bound of their squared distance, and
the more segments, the closer. As the distance is the two squared norms less
twice the inner product, each lower bound of the distance is an upper bound of
the score: the sum of n * (m * m' + s * s'). A candidate whose bound at some
resolution is below the k-th best score so far is out; the others go to the
next resolution, and what is left is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import written

# Segments of each resolution.
RESOLUTIONS = (4, 16)
# Different query vectors that a task holds, and candidates that it lets stream past at most.
QUERY_BLOCK = 8192
STRIPE = 4_000_000
# Queries and candidates of a bound matrix.
ROWS, COLUMNS = 256, 4096
# Pairs are scored one by one where fewer than this part of a matrix is left.
FEW = 16
# Sums of products below this are exact in double precision.
EXACT = 2.0**53


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector and segment the mean and the deviation, each times the root of the segment's length.

    The dot product of two such rows is the upper bound of the inner product.
    """
    edges = np.linspace(0, vectors.shape[1], min(segments, max(1, vectors.shape[1])) + 1).astype(int)
    if not vectors.shape[1]:
        return np.zeros((len(vectors), 2))
    n = np.diff(edges)
    mean = np.add.reduceat(vectors, edges[:-1], axis=1) / n
    spread = vectors - np.repeat(mean, n, axis=1)
    deviation = np.sqrt(np.add.reduceat(spread * spread, edges[:-1], axis=1) / n)
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([n, n]))


def as_matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors one below the other; shorter ones are padded with zeros."""
    found = np.zeros((len(rows), width), np.int64)
    for at, row in enumerate(rows):
        found[at, : len(row)] = row
    return found


class Search:
    """The ``keep`` best candidates so far of each of some query vectors, by (score down, key up)."""

    def __init__(self, queries: np.ndarray, keep: int):
        self.keep = keep
        self.exact = queries
        self.width = queries.shape[1]
        self.vectors = queries.astype(float)
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.bounds = [segment_statistics(self.vectors, n) for n in RESOLUTIONS]
        # Best so far as columns query, score, key, candidate; and each query's worst kept score.
        self.best = [np.empty(0, np.int64) for _ in range(4)]
        self.least = np.full(len(queries), -np.inf)
        # Pairs whose bound was worked out at each resolution, and pairs scored.
        self.seen = [0] * (len(RESOLUTIONS) + 1)

    def add(self, candidates: np.ndarray, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Let candidates pass: ``keys`` order equal scores, ``numbers`` name them in the result."""
        vectors = candidates.astype(float)
        norms = np.sqrt((vectors**2).sum(axis=1))
        bounds = [segment_statistics(vectors, n) for n in RESOLUTIONS]
        for start in range(0, len(self.vectors), ROWS):
            rows = slice(start, start + ROWS)
            # Rounding of a bound is far below this share of the product of the norms.
            slack = 1e-9 * self.norms[rows].max(initial=0) * norms + 1e-9
            alive, needed = np.arange(len(vectors)), np.ones((0, 0), bool)
            for level, bound in enumerate(bounds):
                self.seen[level] += len(self.vectors[rows]) * len(alive)
                most = self.bounds[level][rows] @ bound[alive].T
                needed = most + slack[alive] >= self.least[rows, None]
                # Columns that some query of these rows still needs.
                some = needed.any(axis=0)
                alive, needed = alive[some], needed[:, some]
            if len(alive):
                self._score(start, needed, alive, vectors, candidates, keys, numbers, norms)

    def _score(self, start, needed, alive, vectors, candidates, keys, numbers, norms) -> None:
        """Exact scores of the pairs that are left: one by one if they are few, else with the rest of their columns."""
        rows = slice(start, start + ROWS)
        exact = self.norms[rows].max(initial=0) * norms[alive].max(initial=0) < EXACT
        # Python's numbers have no limit; a score that is no long fails.
        left = self.vectors[rows] if exact else self.exact[rows].astype(object)
        right = vectors if exact else candidates.astype(object)
        least = self.least[rows].astype(left.dtype)
        if exact and needed.sum() * FEW < needed.size:
            query, at = np.nonzero(needed)
            scores = np.einsum("ij,ij->i", left[query], right[alive[at]])
            self.seen[-1] += len(scores)
            good = scores >= least[query]
            query, at, scores = query[good], at[good], scores[good]
        else:
            score = left @ right[alive].T
            self.seen[-1] += score.size
            if len(alive) > self.keep:
                kth = -(np.partition(-score, self.keep - 1, axis=1) if exact else np.sort(-score, axis=1))
                least = np.maximum(least, kth[:, self.keep - 1])
            query, at = np.nonzero(score >= least[:, None])
            scores = score[query, at]
        found = [query + start, np.array(scores, np.int64), keys[alive[at]], numbers[alive[at]]]
        touched = np.unique(found[0])
        mine = np.isin(self.best[0], touched)
        pool = [np.concatenate([old[mine], new]) for old, new in zip(self.best, found, strict=True)]
        order = np.lexsort((pool[2], -pool[1], pool[0]))
        pool = [column[order] for column in pool]
        first = np.searchsorted(pool[0], pool[0])
        place = np.arange(len(pool[0])) - first
        pool, place = [column[place < self.keep] for column in pool], place[place < self.keep]
        full = place == self.keep - 1
        self.least[pool[0][full]] = pool[1][full]
        self.best = [np.concatenate([old[~mine], new]) for old, new in zip(self.best, pool, strict=True)]


def _searched(keep: int):
    """Rows of cells (cell, is_candidate, number, key, vector), queries first, to the best pairs of each cell."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, query_numbers, waiting, width, found = None, [], [], [], 0, None

        def run_through() -> None:
            nonlocal found, waiting
            if found is None:
                found = Search(as_matrix(queries, width), keep)
            if waiting:
                vectors, keys, numbers = zip(*waiting, strict=True)
                found.add(as_matrix(vectors, found.width), np.array(keys, np.int64), np.array(numbers, np.int64))
                waiting = []

        def done() -> Iterator[pa.RecordBatch]:
            if not queries:
                return
            run_through()
            query, score, _, number = found.best
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(query_numbers, np.int64)[query]), pa.array(score), pa.array(number)],
                ["query", "score", "number"],
            )

        for batch in batches:
            cells, kinds, widths, numbers, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            column = batch.column(5)
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            for at in range(batch.num_rows):
                if cells[at] != cell:
                    yield from done()
                    cell, queries, query_numbers, waiting, found = cells[at], [], [], [], None
                width, vector = int(widths[at]), values[offsets[at] : offsets[at + 1]]
                if kinds[at]:
                    waiting.append((vector, keys[at], numbers[at]))
                    if len(waiting) >= COLUMNS:
                        run_through()
                else:
                    queries.append(vector)
                    query_numbers.append(numbers[at])
        yield from done()

    return search


def _blocks(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def best_pairs(vectors: DataFrame, queries: DataFrame, keep: int) -> DataFrame:
    """(query, score, number): for each query the ``keep`` best of all vectors, by (score down, key up), among others.

    ``vectors`` has (number, key, vector), ``queries`` (number, vector); numbers
    are unique. The query set is met with all vectors in blocks: a cell holds a
    block of queries and lets a stripe of the vectors stream past, long vectors
    first, as those have the large scores. Neither is ever in one place as a
    whole. The result holds the best of each cell.
    """
    spark = vectors.sparkSession
    n_queries, n_vectors = queries.count(), vectors.count()
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = _blocks(n_queries, QUERY_BLOCK)
    # Large tables have stripes of full length, small ones enough for all cores.
    stripes = max(_blocks(n_vectors, STRIPE), _blocks(2 * spark.sparkContext.defaultParallelism, blocks))
    block = F.pmod(F.xxhash64("number"), F.lit(blocks))
    stripe = F.pmod(F.xxhash64("number"), F.lit(stripes))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    asked = queries.select(
        "number", F.lit(0).cast("long").alias("key"), "vector", block.alias("block"), F.lit(0.0).alias("place"),
        F.lit(0).alias("is_candidate"), every(stripes).alias("stripe"),
    )
    passing = vectors.select(
        "number", "key", "vector", every(blocks).alias("block"), (-norm).alias("place"), F.lit(1).alias("is_candidate"),
        stripe.alias("stripe"),
    )
    cells = asked.unionByName(passing).withColumn(
        "cell", (F.col("block") * F.lit(stripes) + F.col("stripe")).cast("int")
    )
    dealt = cells.repartitionById(blocks * stripes, F.col("cell")).sortWithinPartitions("cell", "is_candidate", "place")
    ready = dealt.select("cell", "is_candidate", F.lit(width).alias("width"), "number", "key", "vector")
    return ready.mapInArrow(_searched(keep), "query long, score long, number long")


def exact_top_k(
    table: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", vec_id: str = "vec_id", scale: float = 64.0
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k other rows of highest integer inner product.

    Components count as floor(scale * x). Rows without an id, and vectors that
    are null or hold a null or non-finite component, take no part; shorter
    vectors count as padded with zeros, empty ones as zero. Equal rows count
    once; rows of the query's own id are not its candidates. Ties go to the
    smaller id. A score beyond 64 bits is an error. Other columns are not read.
    An empty table gives no rows.

    Equal vectors are searched once: of each, only the k + 1 smallest ids can
    be in a result, and all its queries get the result of the vector.
    """
    codes = F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    usable = F.col("vector").isNotNull() & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    )
    rows = table.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    rows = written(
        rows.where(F.col("id").isNotNull() & usable).select("id", codes.alias("vector"), "asks").distinct(), "vectors"
    )
    least = Window.partitionBy("vector").orderBy("id")
    limited = rows.select("id", "vector", F.row_number().over(least).alias("n")).where(F.col("n") <= k + 1)
    vectors = written(
        limited.groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("number"), F.col("ids")[0].alias("key"), "ids", "vector"),
        "different-vectors",
    )
    members = written(
        rows.where("asks").select(F.col("id").alias("query_id"), "vector").join(
            vectors.select("number", F.col("vector").alias("own_vector")), F.col("vector") == F.col("own_vector")
        ).select("query_id", "number"),
        "queries",
    )
    queries = vectors.join(members.select("number").distinct(), "number", "left_semi")
    pairs = best_pairs(vectors.select("number", "key", "vector"), queries.select("number", "vector"), k + 1)
    # A cell's best meet the ids of their vectors, then the best of all cells of a query.
    hits = pairs.join(vectors.select("number", "key", "ids"), "number")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    best = hits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    each = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("down"), i.alias("id")))
    found = best.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list(each))).alias("found"))
    found = written(found.select("query", F.slice("found", 1, k + 1).alias("found")), "best-of-vectors")
    others = F.slice(F.filter("found", lambda h: h["id"] != F.col("query_id")), 1, k)
    answers = members.join(found, F.col("number") == F.col("query"))
    return answers.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.down")).alias("score")
    )
