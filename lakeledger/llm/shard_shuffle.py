"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows each input partition sends to each shard is drawn first, so that
the row sums are the partitions' sizes and the column sums the shards' sizes,
with the probabilities that a uniform permutation of all rows has. Each
partition permutes its rows and deals them out by its row of the matrix, the
rows are exchanged, and each shard permutes what it got. No record is seen by
the driver: it gets one count per partition and draws the matrix.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakeledger.llm.common import durable

# Rows that a piece of a shard has on average in the second permutation.
PIECE_ROWS = 100_000
# Matrix cells (8 bytes each) that may be broadcast.
BROADCAST_CELLS = 2_000_000


def hypergeometric(good: int, bad: int, draws: int, rng: random.Random) -> int:
    """Good ones among ``draws`` from good + bad without replacement, by the ratio of uniforms."""
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    if low >= high:
        return low
    weight = lambda k: -(
        math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(draws - k + 1) + math.lgamma(bad - draws + k + 1)
    )
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    top = weight(mode)
    if high - low <= 60:
        # Few values: inversion over all of them.
        shares = [math.exp(weight(k) - top) for k in range(low, high + 1)]
        return rng.choices(range(low, high + 1), shares)[0]
    share = good / total
    spread = math.sqrt(draws * share * (1 - share) * (total - draws) / (total - 1) + 0.5)
    # The hat of a unimodal law with this deviation (fixed values of the method).
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    centre = draws * share + 0.5
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = math.floor(centre + width * (v - 0.5) / u)
        if low <= k <= high and 2 * math.log(u) <= weight(k) - top:
            return k


def matrix(rows: list[int], columns: list[int], rng: random.Random) -> list[list[int]]:
    """A random matrix with these row and column sums, distributed as by a uniform permutation."""
    left, drawn = list(columns), []
    for size in rows:
        rest, row = sum(left), []
        for k, have in enumerate(left):
            rest -= have
            got = hypergeometric(have, rest, size, rng)
            row.append(got)
            left[k] -= got
            size -= got
        drawn.append(row)
    return drawn


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard) added.

    The numbers of rows of any two shards differ by one at most (the first
    shards have the larger number), and every assignment is equally likely.
    All columns are carried along, so give narrow rows where the rest can be
    joined later; columns named shard and slot are replaced. Rows are told
    apart by their place in the input, so repeated rows, nulls and ties need no
    special care. An empty table gives an empty result.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    # Fixed once, so that a repeated task finds the same partitions and keys.
    base = durable(
        rows.select(F.struct(*names).alias("row") if names else F.struct(F.lit(None).alias("_")).alias("row"))
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id())
    )
    counted = base.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    total = sum(r["n"] for r in counted)
    rng = random.Random(seed)
    quotas = [total // shards + (j < total % shards) for j in range(shards)]
    drawn = matrix([r["n"] for r in counted], quotas, rng)
    ends = [
        (r["part"], [sum(row[: j + 1]) for j in range(shards)]) for r, row in zip(counted, drawn, strict=True)
    ]
    plan = rows.sparkSession.createDataFrame(ends, "plan_part int, ends array<long>")
    if len(ends) * shards <= BROADCAST_CELLS:
        plan = F.broadcast(plan)
    # The first permutation: the rows of a partition in the order of a keyed hash of their places.
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit(1), "place"), "place")
    dealt = (
        base.withColumn("at", F.row_number().over(local) - 1)
        .join(plan, F.col("part") == F.col("plan_part"))
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("at"))))
    )
    # The second: a shard in the order of another hash, in pieces of neighbouring hashes.
    pieces = max(1, math.ceil(total / max(1, shards) / PIECE_ROWS))
    key = F.xxhash64(F.lit(seed), F.lit(2), "place")
    dealt = durable(
        dealt.select("row", "place", "shard", key.alias("key")).withColumn(
            "piece",
            F.floor((F.shiftrightunsigned("key", 11).cast("double") / F.lit(float(1 << 53))) * pieces).cast("int"),
        )
    )
    sizes = dealt.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("shard").alias("o_shard"), F.col("piece").alias("o_piece"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
    )
    if pieces * shards <= BROADCAST_CELLS:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("shard", "piece").orderBy(F.shiftrightunsigned("key", 11), "key", "place")
    return (
        dealt.withColumn("nth", F.row_number().over(inside) - 1)
        .join(offsets, (F.col("shard") == F.col("o_shard")) & (F.col("piece") == F.col("o_piece")))
        .select(
            *(F.col("row")[c].alias(c) for c in names), "shard", (F.col("offset") + F.col("nth")).alias("slot")
        )
    )
