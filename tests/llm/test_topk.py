"""Exact top-k search against all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeledger.llm import vector_topk as v
from lakeledger.llm.queries import ORACLES, QUERIES
from tests.check_oracle import normal, oracle
from tests.llm import helpers as h


def plain(rows, k):
    """(query id, rank, id, score) by all pairs of usable different rows."""
    usable = {
        (i, tuple(math.floor(64 * x) for x in vector))
        for i, vector in rows
        if i is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    }
    found = []
    for i, a in usable:
        if i % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in usable if j != i)
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return Counter(found)


def run(spark, rows, k=20):
    clash = ("id", "asks", "number", "key", "ids", "cell", "query", "found", "vector", "score")
    df = spark.createDataFrame(
        [(i, x, *clash) for i, x in rows],
        "vec_id long, embedding array<double>, " + ", ".join(f"{c} string" for c in clash),
    )
    return Counter(tuple(r) for r in v.exact_top_k(df, F.col("vec_id") % 20 == 0, k).collect())


def gauss(rng, n=8):
    return [rng.gauss(0, 1) for _ in range(n)]


@pytest.mark.parametrize("block, stripe", [(8192, 4_000_000), (3, 40)])
def test_any_vectors(spark, monkeypatch, block, stripe):
    """Copies in a third of the rows, ties, one cell or many."""
    monkeypatch.setattr(v, "QUERY_BLOCK", block)
    monkeypatch.setattr(v, "STRIPE", stripe)
    rng = random.Random(1)
    hot = gauss(rng)
    rows = [(i, hot if i % 3 == 0 else [rng.choice((-1.0, 0.5)) for _ in range(3)] if i % 3 == 1 else gauss(rng)) for i in range(400)]
    assert run(spark, rows) == plain(rows, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, []), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (None, [1.0, 2.0]),
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0]), (3, [0.0, 0.0, 5.0]), (120, [1e7, -1e7]), (140, [-1e7, 2e7]), (7, [-0.001, 0.999]),
        (0, [1.0, 2.0]), (-20, [2.5, -1.0]),
    ]
    assert run(spark, rows) == plain(rows, 20)
    assert run(spark, rows, k=2) == plain(rows, 2)
    assert run(spark, []) == Counter()


def test_bounds():
    """A bound is never below the score, and closer at more segments; vectors of any length."""
    rng = np.random.default_rng(1)
    for width in (1, 3, 17, 64):
        a, b = rng.integers(-40, 40, (50, width)).astype(float), rng.integers(-40, 40, (60, width)).astype(float)
        coarse, fine = (v.segment_statistics(a, n) @ v.segment_statistics(b, n).T for n in (2, 4))
        assert (coarse + 1e-6 >= fine).all() and (fine + 1e-6 >= a @ b.T).all()
        lower = (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * fine
        assert (((a[:, None] - b) ** 2).sum(2) + 1e-6 >= lower).all()


def test_pruning():
    """Of vectors in clusters the bounds leave few pairs, and all that count."""
    rng = np.random.default_rng(2)
    centres = np.repeat(rng.normal(0, 40, (40, 8)), 8, axis=1)
    vectors = np.rint(centres[rng.integers(0, 40, 9000)] + rng.normal(0, 3, (9000, 64))).astype(np.int64)
    search = v.Search(vectors[:300], 5)
    for at in range(0, 9000, 2000):
        part = np.arange(at, min(at + 2000, 9000))
        search.add(vectors[part], part, part)
    scores = vectors[:300] @ vectors.T
    want = [(q, scores[q, c], c) for q in range(300) for c in np.lexsort((np.arange(9000), -scores[q]))[:5]]
    query, score, _, number = (x.tolist() for x in search.best)
    assert sorted(zip(query, score, number)) == sorted((q, int(s), int(c)) for q, s, c in want)
    assert search.seen[-1] < 0.4 * search.seen[0] == 0.4 * 300 * 9000


def test_query(spark):
    want = oracle(h.SF).execute(ORACLES["op13_exact_top_k_search"])
    names = [c[0] for c in want.description]
    found = QUERIES["op13_exact_top_k_search"](spark, h.SF)
    assert normal(names, want.fetchall()) == normal(found.columns, found.collect())
