"""Merkle manifest of a dataset: a tree per group, a tree over the groups, versions by path copying.

Leaves are sorted by range, so that every leaf gets its position in its group
without a group meeting in one task. A tree is cut into aligned blocks of
``FANOUT ** HEIGHT`` leaves. A block is a persistent tree: nodes are never
changed, and a tampered leaf makes a version, a root of its own that shares
all nodes with the other versions but the copied path of its ancestors. The
roots of the blocks are the leaves of the next, much smaller table of blocks,
and so on up to one root; versions go on from the block's root over the upper
nodes, which they share too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import durable

# Nodes that a parent joins, and levels of a block: 729 leaves.
FANOUT = 3
HEIGHT = 6
# Rows that a task gathers before it works out their blocks.
GATHERED = 2000

_NODE = "tree string, position long, total long, digest binary, changed binary"
_FOUND = ", root binary, version binary, siblings binary, shape binary"


def levels_of(leaves: int) -> int:
    """Levels above so many leaves until one node remains."""
    levels, reach = 0, 1
    while reach < leaves:
        levels, reach = levels + 1, reach * FANOUT
    return levels


def join_digests(parts: Sequence[bytes]) -> bytes:
    """SHA-256 of digests, written as lowercase hex one after the other."""
    return sha256(b"".join(parts).hex().encode()).digest()


class PersistentTree:
    """An append-only store of nodes; every version is a root in it.

    The first version has the given leaves and so many levels above them.
    ``version`` copies the path of one leaf and shares every other node.
    """

    def __init__(self, leaves: Sequence[bytes], levels: int):
        self.digests: list[bytes] = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.levels = [range(len(leaves))]
        for _ in range(levels):
            below = self.levels[-1]
            start = len(self.digests)
            for at in range(below.start, below.stop, FANOUT):
                self._add(tuple(range(at, min(at + FANOUT, below.stop))))
            self.levels.append(range(start, len(self.digests)))
        self.root = len(self.digests) - 1

    def _add(self, children: tuple[int, ...]) -> int:
        self.digests.append(join_digests([self.digests[c] for c in children]))
        self.children.append(children)
        return len(self.digests) - 1

    def siblings(self, leaf: int) -> list[tuple[list[bytes], list[bytes]]]:
        """Level by level the digests left and right of the path in its runs."""
        found, at = [], leaf
        for level in range(1, len(self.levels)):
            own, at = at % FANOUT, at // FANOUT
            run = [self.digests[c] for c in self.children[self.levels[level][at]]]
            found.append((run[:own], run[own + 1 :]))
        return found

    def version(self, leaf: int, digest: bytes) -> int:
        """Root of the version in which the leaf has another digest."""
        self.digests.append(digest)
        self.children.append(())
        new, at = len(self.digests) - 1, leaf
        for level in range(1, len(self.levels)):
            own, at = at % FANOUT, at // FANOUT
            run = self.children[self.levels[level][at]]
            new = self._add((*run[:own], new, *run[own + 1 :]))
        return new


def pack(path: list[tuple[list[bytes], list[bytes]]]) -> tuple[bytes, bytes]:
    """(digests in order, a byte per level that tells how many stand left and right)."""
    shape = bytes(len(left) * FANOUT + len(right) for left, right in path)
    return b"".join(d for left, right in path for d in (*left, *right)), shape


def fold(digest: bytes, siblings: bytes, shape: bytes) -> bytes:
    """The digest at the end of a path: each step is the copied ancestor of the last one."""
    at = 0
    for code in shape:
        left, right = divmod(code, FANOUT)
        middle, end = at + 32 * left, at + 32 * (left + right)
        digest, at = join_digests((siblings[at:middle], digest, siblings[middle:end])), end
    return digest


def _block(rows: pa.Table) -> list[list]:
    """New columns (root, version, siblings, shape) of the rows of one block."""
    leaves, changed = rows.column("digest").to_pylist(), rows.column("changed").to_pylist()
    tree = PersistentTree(leaves, min(HEIGHT, levels_of(rows.column("total")[0].as_py())))
    root = tree.digests[tree.root]
    versions, siblings, shapes = [], [], []
    for at, other in enumerate(changed):
        path, shape = pack(tree.siblings(at))
        # An untouched leaf is proved by its siblings; a tampered one has its version.
        versions.append(fold(leaves[at], path, shape) if other is None else tree.digests[tree.version(at, other)])
        siblings.append(path)
        shapes.append(shape)
    return [[root] * len(leaves), versions, siblings, shapes]


def _climb_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole blocks, sorted by position, to the same rows with what their block says."""
    size = FANOUT**HEIGHT
    held: list[pa.RecordBatch] = []

    def done() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        starts = [*np.flatnonzero(rows.column("position").to_numpy() % size == 0).tolist(), rows.num_rows]
        added: list[list] = [[], [], [], []]
        for start, end in zip(starts, starts[1:]):
            for column, values in zip(added, _block(rows.slice(start, end - start)), strict=True):
                column += values
        for name, values in zip(("root", "version", "siblings", "shape"), added, strict=True):
            rows = rows.append_column(name, pa.array(values, pa.binary()))
        yield from rows.to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(batch.column("position").to_numpy() % size == 0)
        if sum(b.num_rows for b in held) >= GATHERED and len(starts):
            held.append(batch.slice(0, starts[0]))
            yield from done()
            held, batch = [], batch.slice(starts[0])
        held.append(batch)
    if held:
        yield from done()


def _blocks(nodes: DataFrame, key_type: str | None = None) -> DataFrame:
    """Every node (with its key, if there is one) with the root and its version of its block, and its siblings inside it."""
    names = ["tree", "position", "total", "digest", "changed", *(["key"] if key_type else [])]
    schema = _NODE + (f", key {key_type}" if key_type else "") + _FOUND
    block = F.floor(F.col("position") / F.lit(FANOUT**HEIGHT))
    gathered = nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    return durable(gathered.select(*names).mapInArrow(_climb_blocks, schema)).withColumn("block", block)


def _climb(nodes: DataFrame, most: int) -> DataFrame:
    """(tree, position, siblings, shape, root): the whole path of every node of a table of trees.

    ``most`` is the number of leaves of the largest tree. Each round has a
    ``FANOUT ** HEIGHT``-th of the rows of the one before.
    """
    rows = _blocks(nodes)
    if most <= FANOUT**HEIGHT:
        return rows.select("tree", "position", "siblings", "shape", "root")
    return _join_upper(rows, _climb(_block_roots(rows), _blocks_in(most))).select(
        "tree", "position", "siblings", "shape", "root"
    )


def _blocks_in(leaves: int) -> int:
    return -(-leaves // FANOUT**HEIGHT)


def _block_roots(rows: DataFrame) -> DataFrame:
    """The roots of blocks as nodes of the next table."""
    size = F.lit(FANOUT**HEIGHT)
    return rows.where(F.col("position") % size == 0).select(
        "tree",
        F.col("block").alias("position"),
        F.ceil(F.col("total") / size).alias("total"),
        F.col("root").alias("digest"),
        F.lit(None).cast("binary").alias("changed"),
    )


def _join_upper(rows: DataFrame, upper: DataFrame) -> DataFrame:
    """``rows`` with the path above their block (upper_siblings, upper_shape), whole paths, and the root of the tree.

    A block has at most FANOUT ** HEIGHT rows, so no key is hot.
    """
    above = upper.select(
        F.col("tree").alias("upper_tree"),
        F.col("position").alias("upper_position"),
        F.col("siblings").alias("upper_siblings"),
        F.col("shape").alias("upper_shape"),
        F.col("root").alias("upper_root"),
        *[c for c in upper.columns if c.startswith("top_")],
    )
    met = F.col("tree").eqNullSafe(F.col("upper_tree")) & (F.col("block") == F.col("upper_position"))
    return (
        rows.join(above, met)
        .drop("upper_tree", "upper_position")
        .withColumns(
            {
                "siblings": F.concat("siblings", "upper_siblings"),
                "shape": F.concat("shape", "upper_shape"),
                "root": F.col("upper_root"),
            }
        )
    )


def _place(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``position`` in their tree in this order (nulls first) and the ``total`` of the tree.

    Sorted by range: a tree with a third of all rows is spread over tasks. The
    counts that fix the positions are one row per tree and partition.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    lines = durable(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("line", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    of_tree = Window.partitionBy("span_tree")
    spans = (
        lines.groupBy(F.col("tree").alias("span_tree"), F.col("part").alias("span_part"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"))
        .select(
            "span_tree",
            "span_part",
            (F.sum("n").over(of_tree.orderBy("span_part")) - F.col("n") - F.col("first")).alias("shift"),
            F.sum("n").over(of_tree).alias("total"),
        )
    )
    met = F.col("tree").eqNullSafe(F.col("span_tree")) & (F.col("part") == F.col("span_part"))
    return lines.join(spans, met).select(*rows.columns, (F.col("line") + F.col("shift")).alias("position"), "total")


def _largest(nodes: DataFrame) -> int:
    return nodes.agg(F.max("total")).first()[0] or 0


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields, each ``-`` for null, else its number of UTF-8 bytes, a colon and its text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def manifest(leaves: DataFrame) -> DataFrame:
    """The tree over (group, key, digest, changed), one row per leaf.

    ``digest`` is the leaf, ``changed`` what it is after tampering (null: not
    tampered); see ``row_digest``. The rows of a group ascend by key; every
    three neighbours, the last run of a level fewer, become a node until one
    remains. The roots of the groups, in bytewise order with null first, make
    the tree above.

    Gives key, leaf, subroot, root, siblings (the digests beside the path, all
    levels, joined), shape (a byte per level: three times those on the left
    plus those on the right) and folded_root, which the tampered leaf, else
    the leaf itself, and the siblings give. Digests are 32 bytes.

    A null group is a group; null keys come first, and rows of equal key are
    leaves of their own in order of their digests, so repeated rows are all
    there. Other columns are not read. An empty table gives no rows.
    """
    named = leaves.select(
        F.col("group").cast("string").alias("tree"), "key", F.col("digest"), F.col("changed")
    )
    placed = _place(durable(named), ("key", "digest", "changed"))
    rows = _blocks(placed, dict(named.dtypes)["key"])
    most = _largest(rows)
    upper = durable(_climb(_block_roots(rows), _blocks_in(most)))
    none = F.lit(None).cast("binary").alias("changed")
    groups = _place(
        upper.where("position = 0").select(
            F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"), none
        ),
        ("name",),
    )
    names = durable(groups)
    top = _climb(names, _largest(names))
    top_of = names.join(top, "position").select(
        F.col("name"),
        F.col("siblings").alias("name_siblings"),
        F.col("shape").alias("name_shape"),
        F.col("root").alias("top_root"),
    )
    # The path of a block to the top: few rows, joined before the leaves meet them.
    whole = upper.join(top_of, F.col("tree").eqNullSafe(F.col("name"))).select(
        "tree",
        "position",
        F.concat("siblings", "name_siblings").alias("siblings"),
        F.concat("shape", "name_shape").alias("shape"),
        "root",
        "top_root",
    )
    joined = _join_upper(rows, durable(whole))
    return joined.select(
        "key",
        F.col("digest").alias("leaf"),
        F.col("root").alias("subroot"),
        F.col("top_root").alias("root"),
        "siblings",
        "shape",
        _folded(F.col("version"), F.col("upper_siblings"), F.col("upper_shape")).alias("folded_root"),
    )



def _folded(version: Column, siblings: Column, shape: Column) -> Column:
    """A version carried on over the nodes that it shares above its block."""

    @F.arrow_udf("binary")
    def carry(version: pa.Array, siblings: pa.Array, shape: pa.Array) -> pa.Array:
        rows = zip(version.to_pylist(), siblings.to_pylist(), shape.to_pylist(), strict=True)
        return pa.array([fold(*row) for row in rows], pa.binary())

    return carry(version, siblings, shape)
