"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Both tokenizers cut the same bytes, so their tokens are two sorted lists of
ends. Merging the lists gives the overlaps: what lies between two neighbouring
ends belongs to one token of each side. Diagonals cut the merge into pieces of
equal work, each found by a binary search of its own; a piece needs nothing
from its neighbours. An end that stands on both sides of a cut, and a group
that runs over one, are stitched afterwards.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeledger.llm.common import durable, written

# Ends that a piece merges, and bytes of text that a worker encodes at a time.
PIECE = 4096
CHUNK = 1 << 20
# Different linked id pairs up to which their counts are broadcast (some 30 MB); beyond, a shuffle join.
BROADCAST_PAIRS = 1_000_000


# --- the merge


def cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the diagonals 0, piece, 2 * piece, ... cross the merge path of two sorted arrays, and its end.

    All diagonals are searched at once. Of equal ends that of ``a`` goes first.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # On the path the ends of ``a`` taken are those at most as large as the next of ``b``.
        at = np.minimum(middle, len(a) - 1)
        before = np.clip(diagonal - middle - 1, 0, max(len(b) - 1, 0))
        more = open_ & (a[at] <= b[before])
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low, diagonal - low


@dataclass(frozen=True)
class Overlaps:
    """For each different end: the token of each side that holds the bytes before it, and which sides end there."""

    end: np.ndarray
    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


def _piece(a: np.ndarray, b: np.ndarray, first_a: int, first_b: int) -> tuple[np.ndarray, ...]:
    """(end, ends of a so far, ends of b so far) of the different ends of one piece."""
    # Two sorted runs: the stable sort merges them.
    merged = np.concatenate([a * 2, b * 2 + 1])
    merged.sort(kind="stable")
    of_b = np.cumsum(merged & 1)
    end = merged >> 1
    last = np.append(end[1:] != end[:-1], True)
    taken = np.arange(1, len(end) + 1)
    return end[last], first_a + (taken - of_b)[last], first_b + of_b[last]


def overlaps(a: np.ndarray, b: np.ndarray, piece: int) -> Overlaps:
    """Overlaps of two strictly ascending arrays of ends that have the last one in common."""
    at_a, at_b = cuts(a, b, piece)
    parts = [
        _piece(a[i:k], b[j:m], i, j)
        for i, k, j, m in zip(at_a[:-1].tolist(), at_a[1:].tolist(), at_b[:-1].tolist(), at_b[1:].tolist())
    ]
    if not parts:
        none = np.empty(0, np.int64)
        return Overlaps(none, none, none, none.astype(bool), none.astype(bool))
    end, done_a, done_b = (np.concatenate(x) for x in zip(*parts, strict=True))
    # Stitching: an end cut in two is the later one, which has seen both sides.
    last = np.append(end[1:] != end[:-1], True)
    end, done_a, done_b = end[last], done_a[last], done_b[last]
    ends_a, ends_b = np.diff(done_a, prepend=0) > 0, np.diff(done_b, prepend=0) > 0
    return Overlaps(end, done_a - ends_a, done_b - ends_b, ends_a, ends_b)


# --- the tokenizers


@functools.cache
def byte_level(path: str) -> tuple[Tokenizer, list[bytes]]:
    """A byte-level BPE file of the tokenizers library, and the bytes of each id."""
    coder = Tokenizer.from_file(path)
    # The strings of special tokens in a text are plain text.
    coder.encode_special_tokens = True
    # Byte-level alphabet (fixed rule): printable Latin-1 stands for itself, other bytes follow from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    names = [coder.id_to_token(i) or "" for i in range(coder.get_vocab_size(with_added_tokens=True))]
    # Only a special token holds other letters; no text is encoded to it.
    return coder, [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]


@functools.cache
def pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """A sentencepiece model, and the bytes of each id."""
    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [coder.id_to_piece(i) for i in range(coder.get_piece_size())]
    octets = [
        bytes([int(n[3:5], 16)]) if coder.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
    ]
    return coder, octets


class Aligner:
    """Tokens of many texts by two tokenizers, and how they lie over each other."""

    def __init__(self, path_a: str, path_b: str):
        self.coder_a, self.bytes_a = byte_level(path_a)
        self.coder_b, self.bytes_b = pieces(path_b)
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        # Text of every id with what follows it: a comma, or the end of its side of a group.
        words = [f"{i}{after}" for i in range(len(self.bytes_a)) for after in ",|"]
        words += [f"{i}{after}" for i in range(len(self.bytes_b)) for after in ",;"]
        self.words = np.array(words, object)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of each text by both; none where a text is empty or the tokens do not give its bytes back."""
        real = [t for t in texts if t]
        by_a = self.coder_a.encode_batch_fast([" " + t for t in real], add_special_tokens=False)
        by_b = self.coder_b.encode(real, num_threads=1)
        both = zip(by_a, by_b, strict=True)
        for text in texts:
            if not text:
                yield [], []
                continue
            a, b = next(both)
            a, want = a.ids, b" " + text.encode()
            same = b"".join([self.bytes_a[i] for i in a]) == want == b"".join([self.bytes_b[i] for i in b])
            yield (a, b) if same else ([], [])

    def align(self, texts: list[str | None]) -> Alignment:
        a, b, n_a, n_b = [], [], [], []
        for own_a, own_b in self.encode(texts):
            a += own_a
            b += own_b
            n_a.append(len(own_a))
            n_b.append(len(own_b))
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        # The texts stand one behind the other: the end of each is an end on both sides.
        found = overlaps(np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b]), PIECE)
        return Alignment(ids_a, ids_b, np.array(n_a, np.int64), np.array(n_b, np.int64), found)


@dataclass(frozen=True)
class Alignment:
    """Ids of several texts, tokens per text, and the overlaps of all."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    found: Overlaps

    @functools.cached_property
    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, a token, b token) of the tokens that end together, in order. Each closes a group."""
        both = self.found.ends_a & self.found.ends_b
        at_a, at_b = self.found.a[both], self.found.b[both]
        text = np.repeat(np.arange(len(self.n_a)), self.n_a)
        return text[at_a], at_a, at_b

    def groups(self) -> Iterator[list[tuple[list[int], list[int]]]]:
        """The groups of every text, as (ids of a, ids of b)."""
        text, at_a, at_b = self.links
        a, b = self.a.tolist(), self.b.tolist()
        own: list[list] = [[] for _ in self.n_a]
        start_a = start_b = 0
        for t, end_a, end_b in zip(text.tolist(), (at_a + 1).tolist(), (at_b + 1).tolist()):
            own[t].append((a[start_a:end_a], b[start_b:end_b]))
            start_a, start_b = end_a, end_b
        yield from own

    def group_texts(self, words: np.ndarray, first_b: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every text; ``words`` as an Aligner has them."""
        _, at_a, at_b = self.links
        # All tokens in the order of groups, in each those of a and then those of b.
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[at_a], last_b[at_b] = 1, 1
        before_b = np.repeat(np.append(0, at_b + 1)[: len(at_a)], np.diff(at_a, prepend=-1))
        before_a = np.repeat(at_a + 1, np.diff(at_b, prepend=-1))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + before_b] = self.a * 2 + last_a
        code[np.arange(len(self.b)) + before_a] = self.b * 2 + last_b + first_b
        shown, stops = words[code], np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(shown[i:k].tolist())[:-1] for i, k in zip([0, *stops], stops)]

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of the different linked id pairs of each text; a pair is ``a << 32 | b``."""
        text, at_a, at_b = self.links
        size_a, size_b = self.a.max(initial=0) + 1, self.b.max(initial=0) + 1
        code = (text * size_a + self.a[at_a]) * size_b + self.b[at_b]
        code, n = np.unique(code, return_counts=True)
        rest, b = np.divmod(code, size_b)
        text, a = np.divmod(rest, size_a)
        return text, a << 32 | b, n


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about CHUNK characters, one text at least."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


# --- Spark


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, groups): the groups of every text as an array of (a, b), the ids of each side in order.

    ``path_a`` is a byte-level BPE file of the tokenizers library, which
    encodes a space and the text, ``path_b`` a sentencepiece model that puts
    the space itself; both paths are read by the workers. A group ends where
    both tokens end. Null and empty texts, and texts whose tokens do not give
    their bytes back, have no groups. Repeated rows and null ids stay; other
    columns are not read. A text is aligned in one task, in memory in
    proportion to it.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        side = pa.list_(pa.struct({"a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())}))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in chunks(texts):
                found = [[{"a": a, "b": b} for a, b in g] for g in own.align(texts[start:end]).groups()]
                ids = batch.column("doc_id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, side)], ["doc_id", "groups"])

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {kind}, groups array<struct<a: array<int>, b: array<int>>>"
    return named.mapInArrow(align, schema).withColumnRenamed("doc_id", doc_id)


def alignment_counts(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: what its alignment counts, alone and against the whole table.

    n_a, n_b, n_groups, n_links (pairs of tokens that end together), n_best
    (links whose id pair is linked as often in the table as any pair of its b
    id), count_sum (of the table's counts over the links), groups_sha256 (of
    the groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens). Texts, ids and
    columns are treated as by ``aligned_groups``; an empty table gives no rows.

    Texts are encoded once; documents keep their different pairs with counts.
    Pairs are reduced within tasks before they are shuffled. Their counts come
    back by a broadcast up to BROADCAST_PAIRS of them, beyond by a join whose
    sides are bare shuffles, with the same rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in chunks(texts):
                found = own.align(texts[start:end])
                shown = found.group_texts(own.words, 2 * len(own.bytes_a))
                links = np.bincount(found.links[0], minlength=end - start)
                at, pair, times = found.pair_counts()
                offsets = pa.array(np.searchsorted(at, np.arange(end - start + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.array(found.n_a),
                        pa.array(found.n_b),
                        # Tokens have bytes, so a group has one pair that ends together.
                        pa.array(links),
                        pa.array(links),
                        pa.array([sha256(s.encode()).hexdigest() if s else "" for s in shown]),
                        pa.ListArray.from_arrays(offsets, pa.array(pair)),
                        pa.ListArray.from_arrays(offsets, pa.array(times)),
                    ],
                    names,
                )

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
        " pairs array<long>, times array<long>"
    )
    counted = named.mapInArrow(count, schema).withColumn("row", F.monotonically_increasing_id())
    rows = written(counted, "token-alignment")

    linked = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    totals = durable(linked.groupBy("pair").agg(F.sum("times").alias("n")))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = totals.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    judged = durable(
        totals.join(most, b_id == F.col("b")).select(F.col("pair").alias("judged_pair"), "n", (F.col("n") == F.col("most")).alias("is_best"))
    )
    if judged.count() <= BROADCAST_PAIRS:
        judged = F.broadcast(judged)
    sums = (
        linked.join(judged, F.col("pair") == F.col("judged_pair"))
        .groupBy(F.col("row").alias("summed_row"))
        .agg(
            F.sum(F.when(F.col("is_best"), F.col("times"))).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    joined = rows.drop("pairs", "times").join(sums, F.col("row") == F.col("summed_row"), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("doc_id").alias(doc_id),
        "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
