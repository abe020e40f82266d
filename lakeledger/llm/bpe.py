"""Byte-level BPE in numpy matrices: encode texts to token ids and decode them.

A text is cut by the pattern of the vocabulary; equal matches are encoded once
per worker. Matches of similar length stand in one padded matrix of token ids.
Each round looks up every adjacent pair in a hash table of mergeable pairs,
merges the leftmost pair of least rank in every row and closes the gap; rows
without a mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# A matrix is at most so wide; longer matches (no space in so many bytes) go
# through a heap, which is the same rule in n log n steps.
WIDEST = 128
# Matches that a worker remembers, and code points that are cut up at a time.
REMEMBERED = 100_000
CHUNK = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int32(2**31 - 1)


class Vocabulary:
    """A rank file: lines of a base64 token and its rank, which is its id."""

    def __init__(self, lines: Iterable[bytes]):
        self.rank = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}
        tokens = [b""] * (max(self.rank.values(), default=-1) + 1)
        for token, r in self.rank.items():
            tokens[r] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.octets = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_id = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        # Every way to put a token together from two others.
        pairs = {
            (self.rank[t[:i]] << 32) | self.rank[t[i:]]: r
            for t, r in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        }
        self._fill(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.pairs = pairs

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing: all keys that still lack a slot try their next one together."""
        self.shift = np.uint64(64 - max(4, int(len(keys) * 3).bit_length()))
        self.mask = np.int64((1 << (64 - int(self.shift))) - 1)
        self.table_key = np.full(self.mask + 1, np.uint64(2**64 - 1))
        self.table_rank = np.full(self.mask + 1, _NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.table_rank[slot] == _NONE
            self.table_key[slot[free]] = keys[free]
            mine = free & (self.table_key[slot] == keys)
            self.table_rank[slot[mine]] = ranks[mine]
            keys, ranks, slot = keys[~mine], ranks[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged token for pairs of ids; the largest int32 where they don't merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        ranks = np.where(self.table_key[slot] == keys, self.table_rank[slot], _NONE)
        # Neither a hit nor an empty slot: follow the chain.
        open_ = np.flatnonzero((self.table_key[slot] != keys) & (self.table_rank[slot] != _NONE))
        slot, keys = slot[open_], keys[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            hit = self.table_key[slot] == keys
            ranks[open_[hit]] = self.table_rank[slot[hit]]
            go = ~hit & (self.table_rank[slot] != _NONE)
            open_, slot, keys = open_[go], slot[go], keys[go]
        return ranks

    def merge_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece (of at most ``width`` bytes) in a padded matrix, and their numbers."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.full((n, width + 1), -1, np.int32)
        ids[:, :width][np.arange(width) < lengths[:, None]] = self.byte_id[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        rows, live = np.arange(n), ids.copy()
        while len(rows):
            left, right = live[:, :-1], live[:, 1:]
            inside = right >= 0
            ranks = np.full(left.shape, _NONE, np.int32)
            ranks[inside] = self.merge_ranks(left[inside], right[inside])
            at = ranks.argmin(axis=1)  # the leftmost of the least
            best = ranks[np.arange(len(rows)), at]
            go = best != _NONE
            if not go.all():
                ids[rows[~go]] = np.pad(live[~go], ((0, 0), (0, ids.shape[1] - live.shape[1])), constant_values=-1)
                rows, live, at, best = rows[go], live[go], at[go], best[go]
                if not len(rows):
                    break
            # Close the gap behind the merged pair, then drop the columns that no row uses.
            behind = np.arange(live.shape[1] - 1) > at[:, None]
            closed = np.where(behind, live[:, 1:], live[:, :-1])
            closed[np.arange(len(rows)), at] = best
            used = int((closed >= 0).sum(axis=1).max())
            live = np.pad(closed[:, :used], ((0, 0), (0, 1)), constant_values=-1)
        return ids, (ids >= 0).sum(axis=1)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, with a heap of candidate pairs."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        rank = lambda i: self.pairs.get((ids[i] << 32) | ids[after[i]]) if after[i] >= 0 else None
        heap = [(r, i) for i in range(len(ids)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            gone = after[i]
            ids[i], ids[gone], after[i] = r, -1, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for j in (i, before[i]):
                if j >= 0 and (r := rank(j)) is not None:
                    heapq.heappush(heap, (r, j))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, number of ids of each); pieces of similar length share a matrix."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = np.fromiter((self.rank.get(p, -1) for p in pieces), np.int32, len(pieces))
        counts = np.ones(len(pieces), np.int64)
        parts = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        for i in np.flatnonzero((whole < 0) & (lengths > WIDEST)).tolist():
            ids = self.merge_long(pieces[i])
            counts[i] = len(ids)
            parts.append((np.array([i]), ids))
        widest = 0
        for width in (4, 6, 8, 10, 12, 16, 24, 32, 64, WIDEST):
            places = np.flatnonzero((whole < 0) & (lengths > widest) & (lengths <= width))
            widest = width
            step = max(1, (1 << 16) // width)
            for part in (places[at : at + step] for at in range(0, len(places), step)):
                ids, counts[part] = self.merge_rows([pieces[i] for i in part.tolist()], width)
                parts.append((part, ids[ids >= 0]))
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int32)
        for part, ids in parts:
            own = counts[part]
            flat[np.repeat(starts[part] - np.cumsum(own) + own, own) + np.arange(len(ids))] = ids
        return flat, counts


class Encoder:
    """Cuts texts by a pattern and encodes each match by itself; remembers matches up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.cut = vocabulary, regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def learn(self, matches: set[str]) -> None:
        fresh = [m for m in matches if m not in self.known]
        if not fresh:
            return
        if len(self.known) + len(fresh) > REMEMBERED:
            self.forget()
            fresh = list(matches)
        ids, counts = self.vocabulary.encode_pieces([m.encode() for m in fresh])
        self.known.update(zip(fresh, range(len(self.counts), len(self.counts) + len(fresh)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text. Texts are cut up in groups of about CHUNK code points, so that new matches share matrices."""
        found: list[np.ndarray] = []
        group: list[list[str]] = []
        waiting = 0
        for text in texts:
            if len(text) > CHUNK:
                found += self._group(group)
                group, waiting = [], 0
                found.append(np.concatenate([*map(self._ids, self._slices(text)), np.empty(0, np.int32)]))
                continue
            group.append(self.cut.findall(text))
            waiting += len(text)
            if waiting > CHUNK:
                found += self._group(group)
                group, waiting = [], 0
        return found + self._group(group)

    def _slices(self, text: str) -> Iterator[list[str]]:
        matches = self.cut.finditer(text)
        while part := [m[0] for m in itertools.islice(matches, CHUNK // 4)]:
            yield part

    def _group(self, group: list[list[str]]) -> list[np.ndarray]:
        ids = self._ids([*itertools.chain.from_iterable(group)], lengths := [])
        ends = np.cumsum([0, *map(len, group)])
        cuts = np.concatenate([[0], np.cumsum(lengths[0])])[ends] if len(ids) else np.zeros(len(ends), np.int64)
        return [ids[a:b] for a, b in itertools.pairwise(cuts.tolist())]

    def _ids(self, matches: list[str], lengths: list | None = None) -> np.ndarray:
        """Ids of the matches, one after the other; ``lengths`` gets an array of their numbers."""
        if not matches:
            return np.empty(0, np.int32)
        self.learn(set(matches))
        at = np.fromiter(map(self.known.__getitem__, matches), np.int64, len(matches))
        counts = self.counts[at]
        if lengths is not None:
            lengths.append(counts)
        ends = np.cumsum(counts)
        return self.ids[np.repeat(self.starts[at] - ends + counts, counts) + np.arange(ends[-1])]


@functools.lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content.split(b"\n"))


@functools.lru_cache(maxsize=2)
def _encoder(content: bytes, pattern: str) -> Encoder:
    return Encoder(_vocabulary(content), pattern)


def read_ranks(path: str) -> bytes:
    """A rank file as the driver finds it; it travels to the workers with the job (under a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


def encode(text: Column, ranks: bytes, pattern: str) -> Column:
    """Token ids of a text, without special tokens, as array<int>; none for null and empty texts."""

    @F.arrow_udf("array<int>")
    def of_texts(texts: pa.Array) -> pa.Array:
        encoder = _encoder(ranks, pattern)
        rows = encoder.encode_many([t or "" for t in texts.to_pylist()])
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.empty(0, np.int32)])))

    return of_texts(text)


def decode(ids: Column, ranks: bytes) -> Column:
    """The bytes that token ids stand for; none for null and no ids. An unknown id is an error."""

    @F.arrow_udf("binary")
    def of_ids(rows: pa.Array) -> pa.Array:
        v = _vocabulary(ranks)
        found = []
        for row in rows:
            own = _flat(row)
            counts = v.lengths[own]
            ends = np.cumsum(counts)
            at = np.repeat(v.starts[own] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)
            found.append(v.octets[at].tobytes())
        return pa.array(found, pa.binary())

    return of_ids(ids)


def id_bytes(ids: Column) -> Column:
    """Token ids as little-endian unsigned 32-bit numbers, one after the other."""

    @F.arrow_udf("binary")
    def of_ids(rows: pa.Array) -> pa.Array:
        return pa.array([_flat(row).astype("<u4").tobytes() for row in rows], pa.binary())

    return of_ids(ids)


def _flat(row: pa.ListScalar) -> np.ndarray:
    return np.empty(0, np.int64) if row.values is None else row.values.to_numpy(zero_copy_only=False)
