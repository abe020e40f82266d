"""The Merkle manifest against plain trees."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeledger.llm import merkle_manifest as m
from lakeledger.llm.queries import ORACLES, QUERIES
from tests.check_oracle import normal, oracle
from tests.llm import helpers as h


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([joined(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return found


def path(tree, at):
    found = []
    for level in tree[:-1]:
        start = at // 3 * 3
        found.append((level[start:at], level[at + 1 : start + 3]))
        at //= 3
    return found


def plain(rows):
    """Counter of (key, leaf, subroot, root, siblings, folded root) of (group, key, digest, changed) rows."""
    by = {}
    for group, *row in rows:
        by.setdefault(group, []).append(row)
    names = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: levels([r[1] for r in by[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    found = Counter()
    for number, group in enumerate(names):
        for at, (key, leaf, changed) in enumerate(by[group]):
            way = path(trees[group], at) + path(top, number)
            end = changed or leaf
            for left, right in way:
                end = joined(*left, end, *right)
            beside = "".join(d for pair in way for part in pair for d in part)
            found[key, leaf, trees[group][-1][0], top[-1][0], beside, end] += 1
    return found


def run(spark, rows):
    df = spark.createDataFrame(
        [(g, k, bytes.fromhex(d), bytes.fromhex(c) if c else None, "x", "y", "z") for g, k, d, c in rows],
        "group string, key long, digest binary, changed binary, tree string, position string, part string",
    )
    found = m.manifest(df)
    text = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "siblings", "folded_root")]
    return Counter(tuple(r) for r in found.select("key", *text).collect())


def digest(*parts):
    return hashlib.sha256(repr(parts).encode()).hexdigest()


@pytest.mark.parametrize("height", [1, 2, 6])
@pytest.mark.parametrize("partitions", [1, 7])
def test_trees_of_all_sizes(spark, monkeypatch, height, partitions):
    """Every size around the powers of three, over several tables of blocks."""
    monkeypatch.setattr(m, "HEIGHT", height)
    sizes = [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 82]
    rows = [
        (f"g{n}" if n > 1 else None, k, digest(n, k), digest(n, k, "new") if (n + k) % 3 == 0 else None)
        for n in sizes for k in range(n)
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    # Python workers read HEIGHT from the module, so a patched one is only given to the driver's own half.
    try:
        assert list_of(rows) == plain(rows)
        if height == 6:
            assert run(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def list_of(rows):
    """The same tree by the operator's blocks, without Spark."""
    by = {}
    for group, *row in rows:
        by.setdefault(group, []).append(row)
    names = sorted(by, key=lambda g: (g is not None, (g or "").encode()))

    def climb(leaves):
        size = m.FANOUT**m.HEIGHT
        trees = [
            m.PersistentTree(leaves[i : i + size], min(m.HEIGHT, m.levels_of(len(leaves))))
            for i in range(0, len(leaves), size)
        ]
        if len(trees) == 1:
            return [(t, b"", b"") for t in trees], trees[0].digests[trees[0].root]
        upper, root = climb([t.digests[t.root] for t in trees])
        return [(t, *whole(upper, i)) for i, t in enumerate(trees)], root

    def whole(upper, at):
        tree, siblings, shape = upper[at // m.FANOUT**m.HEIGHT]
        own, own_shape = m.pack(tree.siblings(at % m.FANOUT**m.HEIGHT))
        return own + siblings, own_shape + shape

    built = {g: climb([bytes.fromhex(r[1]) for r in sorted(by[g])]) for g in names}
    top, root = climb([built[g][1] for g in names])
    found = Counter()
    for number, g in enumerate(names):
        blocks, subroot = built[g]
        name_siblings, name_shape = whole(top, number)
        for at, (key, leaf, changed) in enumerate(sorted(by[g])):
            siblings, shape = whole(blocks, at)
            tree, upper, upper_shape = blocks[at // m.FANOUT**m.HEIGHT]
            nodes = len(tree.digests)
            version = tree.version(at % m.FANOUT**m.HEIGHT, bytes.fromhex(changed or leaf))
            # A version adds a leaf and its ancestors, and nothing else.
            assert len(tree.digests) - nodes == len(tree.levels)
            end = m.fold(tree.digests[version], upper + name_siblings, upper_shape + name_shape)
            assert end == m.fold(bytes.fromhex(changed or leaf), siblings + name_siblings, shape + name_shape)
            found[key, leaf, subroot.hex(), root.hex(), (siblings + name_siblings).hex(), end.hex()] += 1
    return found


def test_many_blocks_and_odd_rows(spark):
    """A group of several blocks, null keys and groups, repeated rows, clashing columns, an empty table."""
    rows = [("hot", k, digest(k), digest(k, "n") if k % 2 else None) for k in range(2400)]
    rows += [(None, 1, digest("a"), None), (None, None, digest("b"), digest("c")), ("", 5, digest("d"), digest("d"))]
    rows += [("same", 7, digest("e"), digest("f"))] * 5 + [("é", 1, digest("g"), None), ("z", 1, digest("g"), None)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == Counter()


def test_query(spark):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    rows = []
    for i, source, lang, n, text in h.rows_of("documents", "doc_id, source, lang, n_chars, text"):
        leaf = joined(*map(field, (i, source, lang, n, text)))
        changed = joined(*map(field, (i, source, lang, n, text and text.replace("\n", ""))))
        rows.append((source, i, leaf, changed if zlib.crc32(str(i).encode()) % 2 == 0 else None))
    want = Counter()
    for (key, leaf, subroot, root, beside, end), n in plain(rows).items():
        want[key, leaf, subroot, root, joined(beside), end, end == root] += n
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = QUERIES["op11_merkle_manifest"](spark, h.SF)
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == want


def test_oracle(spark):
    want = oracle(h.SF).execute(ORACLES["op11_merkle_manifest"])
    names = [c[0] for c in want.description]
    found = QUERIES["op11_merkle_manifest"](spark, h.SF)
    assert normal(names, want.fetchall()) == normal(found.columns, found.collect())
