"""Token alignment against plain loops."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeledger.llm import token_alignment as ta
from lakeledger.llm.queries import QUERIES
from tests.llm import helpers as h

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ENDS = st.lists(st.integers(1, 400), min_size=1, unique=True).map(sorted)


def plain_groups(text):
    """Groups (ids of a, ids of b) by walking over the bytes."""
    (coder_a, bytes_a), (coder_b, bytes_b) = ta.byte_level(A), ta.pieces(B)
    if not text:
        return []
    a, b = coder_a.encode(" " + text, add_special_tokens=False).ids, coder_b.encode(text)
    want = b" " + text.encode()
    if b"".join(bytes_a[i] for i in a) != want or b"".join(bytes_b[i] for i in b) != want:
        return []
    found, own_a, own_b, end_a, end_b = [], [], [], 0, 0
    a, b = a[::-1], b[::-1]
    while a or b:
        if end_a <= end_b:
            own_a.append(a.pop())
            end_a += len(bytes_a[own_a[-1]])
        else:
            own_b.append(b.pop())
            end_b += len(bytes_b[own_b[-1]])
        if end_a == end_b:
            found.append((own_a, own_b))
            own_a, own_b = [], []
    return found


def plain(docs):
    every = [(i, plain_groups(t)) for i, t in docs]
    total = Counter((a[-1], b[-1]) for _, groups in every for a, b in groups)
    most = {}
    for (_, b), n in total.items():
        most[b] = max(n, most.get(b, 0))
    found = Counter()
    for i, groups in every:
        pairs = [(a[-1], b[-1]) for a, b in groups]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        found[
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(pairs),
            sum(total[p] == most[p[1]] for p in pairs), sum(total[p] for p in pairs),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ] += 1
    return found


def rows(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS, st.integers(1, 50))
def test_pieces(a, b, piece):
    """Pieces of any size give the overlaps of a plain walk, and none has more work than it should."""
    last = max(a[-1], b[-1]) + 1
    a, b = np.array([*a, last]), np.array([*b, last])
    at_a, at_b = ta.cuts(a, b, piece)
    work = np.diff(at_a) + np.diff(at_b)
    assert (work[:-1] == piece).all() and work[-1] <= piece
    found = ta.overlaps(a, b, piece)
    ends = sorted({*a.tolist(), *b.tolist()})
    assert found.end.tolist() == ends
    assert found.a.tolist() == np.searchsorted(a, ends).tolist() and found.b.tolist() == np.searchsorted(b, ends).tolist()
    assert found.ends_a.tolist() == [e in a for e in ends] and found.ends_b.tolist() == [e in b for e in ends]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(), max_size=4), st.integers(1, 9))
def test_any_texts(texts, piece):
    own = ta.aligner(A, B)
    before, ta.PIECE = ta.PIECE, piece
    try:
        found = own.align(texts)
        assert list(found.groups()) == [plain_groups(t) for t in texts]
        want = [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain_groups(t)) for t in texts]
        assert found.group_texts(own.words, 2 * len(own.bytes_a)) == want
    finally:
        ta.PIECE = before


def test_query(spark):
    assert rows(QUERIES["op12_cross_tokenizer_alignment"](spark, h.SF)) == plain(h.documents())


@pytest.mark.parametrize("most", [0, 10**6])
def test_odd(spark, monkeypatch, most):
    """Odd rows, special tokens' strings, bytes without pieces, ties, clashing columns; with and without broadcast."""
    monkeypatch.setattr(ta, "BROADCAST_PAIRS", most)
    odd = [*h.ODD, (20, "<|endoftext|><s></s><unk>"), (21, " ▁ lower▁one"), (22, "\x00\U0001f9ff é"), (23, "a  b\n\n\nc ")]
    clash = ["row", "pairs", "times", "n", "pair", "groups", "n_a", "summed_row", "judged_pair", "is_best"]
    df = spark.createDataFrame([(i, t, *clash) for i, t in odd], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))
    assert rows(ta.alignment_counts(df, A, B)) == plain(odd)
    got = [(r["doc_id"], [(g["a"], g["b"]) for g in r["groups"]]) for r in ta.aligned_groups(df, A, B).collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, plain_groups(t))) for i, t in odd)
    assert ta.alignment_counts(df.where("false"), A, B).count() == 0
