"""Passages that recur across documents: paragraph MinHash banding with exact verification.

Paragraphs are of two kinds. Lines of at least MIN_WORDS words get MinHash
signatures of their word shingles; lines that collide in a band are verified by
exact Jaccard similarity and linked. A passage inside a longer line shows in
anchored paragraphs: windows of WINDOW words that begin where the hash of two
neighbouring words is the least of ANCHORS places. Whatever stands around a
passage, its words place the same windows, and of MIN_WORDS equal words at
least one window lies wholly inside; these collide on all their words. Linked
paragraphs are clustered by connected components.
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
from lakeledger.operators.joins import splittable_join

MIN_WORDS = 50
WINDOW = 25
ANCHORS = MIN_WORDS - WINDOW
WIDTH = 5
SIMILARITY = 0.8
# Bands of two minima: at a similarity of 0.8 the chance to collide in none is
# (1 - 0.64) ** 8 = 0.0003.
BANDS, ROWS = 8, 2
# Lines that are compared with one another in one task.
BLOCK_LINES = 1000
# Document ids that may be broadcast (8 bytes each).
BROADCAST_ROWS = 300_000

_RNG = np.random.default_rng(7)
_POWERS = _RNG.integers(1, 2**63, max(WINDOW, WIDTH), dtype=np.uint64) | np.uint64(1)
_SALTS = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_FACTOR = np.uint64(0xBF58476D1CE4E5B9)
# Words of a batch of texts that are worked on at a time; a longer text is worked on alone.
_STEP = 20_000


def _fold(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(30))


def _spread(x: np.ndarray) -> np.ndarray:
    """Second half of a mix; overwrites ``x``."""
    x *= _FACTOR
    x ^= x >> np.uint64(31)
    return x


def _mix(x: np.ndarray) -> np.ndarray:
    return _spread(_fold(x))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every ``width`` neighbouring words."""
    n = len(hashes) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(width if n > 0 else 0):
        total += hashes[i : i + n] * _POWERS[i]
    return _mix(total)


def _least_places(x: np.ndarray, span: int) -> np.ndarray:
    """Place of the first least number of every ``span`` neighbouring ones."""
    least, places, width = x, np.arange(len(x)), 1
    while width < span:
        # Two overlapping runs make a longer one.
        step = min(width, span - width)
        left, right = least[:-step], least[step:]
        places = np.where(right < left, places[step:], places[:-step])
        least = np.minimum(left, right)
        width += step
    return places


def anchored(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First words of the anchored windows of texts that follow one another and end at ``ends``."""
    if len(hashes) <= ANCHORS:
        return np.empty(0, np.int64)
    places = _least_places(rolling(hashes, 2), ANCHORS)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(hashes))
    # The places of neighbouring runs ascend, so equal ones follow one another.
    places = places[left[: len(places)] > ANCHORS]
    starts = places[np.diff(places, prepend=-1) > 0]
    return starts[left[starts] >= WINDOW]


def window_hashes(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return _mix((hashes[starts[:, None] + np.arange(WINDOW)] * _POWERS[:WINDOW]).sum(axis=1, dtype=np.uint64))


def bands(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number per line and band of the MinHash signatures of lines, which are ascending parts of ``hashes``."""
    shingles = _fold(rolling(hashes, WIDTH))
    # Shingles from a line's start to its last one; what lies between the lines is left out.
    edges = np.stack([starts, ends - WIDTH + 1], axis=1).ravel()
    edges = edges[: -1 if edges[-1] == len(shingles) else None]
    # Folding is linear: that of a salted shingle comes from those of the salt and the shingle.
    least = np.stack([np.minimum.reduceat(_spread(shingles ^ salt), edges)[::2] for salt in _fold(_SALTS)], axis=1)
    least = least.reshape(-1, BANDS, ROWS)
    return _mix(least[:, :, 0] * _POWERS[0] + least[:, :, 1] * _POWERS[1] + np.arange(BANDS, dtype=np.uint64))


def line_key(hashes: np.ndarray) -> int:
    """Identity of a line's words."""
    octets = hashes.astype("<u8").tobytes()
    return xxhash.xxh64_intdigest(octets)


def words_of_lines(text: str) -> list[list[bytes]]:
    return [line.split() for line in text.encode().lower().split(b"\n")]


def _signed(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


PARAGRAPHS = (
    "doc long, window_keys array<long>, window_starts array<int>, "
    "line_keys array<long>, line_starts array<int>, line_sizes array<int>, line_bands array<long>"
)


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchored windows and long lines of every text, in one pass; ``line_bands`` has BANDS numbers per line."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        first, words, ends, spots = 0, [], [0], []
        for i, text in enumerate(texts):
            for line in words_of_lines(text.as_py() or ""):
                if len(line) >= MIN_WORDS:
                    spots.append((len(words), len(words) + len(line)))
                words += line
            ends.append(len(words))
            if len(words) >= _STEP or i == len(texts) - 1:
                yield _paragraphs_of(ids[first : i + 1], words, ends, spots)
                first, words, ends, spots = i + 1, [], [0], []


def _paragraphs_of(ids: pa.Array, words: list[bytes], ends: list[int], spots: list[tuple[int, int]]) -> pa.RecordBatch:
    """Row per text of texts that follow one another, with the long lines at ``spots``."""
    hashes, ends = word_hashes(words), np.array(ends)
    starts = anchored(hashes, ends[1:])
    lines = np.array(spots, np.int64).reshape(-1, 2)
    keys = [line_key(hashes[a:b]) for a, b in spots]
    found = bands(hashes, lines[:, 0], lines[:, 1]) if spots else np.empty((0, BANDS), np.uint64)
    window_ends, line_ends = np.searchsorted(starts, ends), np.searchsorted(lines[:, 0], ends)

    def listed(edges: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))

    def within(edges: np.ndarray, places: np.ndarray) -> np.ndarray:
        return (places - np.repeat(ends[:-1], np.diff(edges))).astype(np.int32)

    return pa.RecordBatch.from_arrays(
        [
            ids,
            listed(window_ends, _signed(window_hashes(hashes, starts))),
            listed(window_ends, within(window_ends, starts)),
            listed(line_ends, _signed(keys)),
            listed(line_ends, within(line_ends, lines[:, 0])),
            listed(line_ends, np.diff(lines, axis=1).ravel().astype(np.int32)),
            listed(line_ends * BANDS, _signed(found).ravel()),
        ],
        ["doc", "window_keys", "window_starts", "line_keys", "line_starts", "line_sizes", "line_bands"],
    )


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct shingle hashes of the asked-for lines of a text."""
    for batch in batches:
        keys, sets = [], []
        for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            wanted, at = set(wanted), 0
            for words in words_of_lines(text.as_py() or ""):
                if at in wanted and len(words) >= MIN_WORDS:
                    hashes = word_hashes(words)
                    keys.append(line_key(hashes))
                    sets.append(np.unique(_signed(rolling(hashes, WIDTH))))
                at += len(words)
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_signed(keys)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))],
            ["key", "shingles"],
        )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the lines of a block which links of exact similarity connect.

    Rows come sorted by block; one that a batch cuts waits for its other rows.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        blocks = np.stack([rows.column(c).to_numpy() for c in ("band", "low", "high")])
        starts = np.flatnonzero((blocks[:, 1:] != blocks[:, :-1]).any(axis=0)) + 1
        starts = [0, *starts.tolist()]
        rest = rows.slice(starts[-1])
        if len(starts) > 1:
            yield _linked_blocks(rows.slice(0, starts[-1]), starts)
    if rest is not None:
        yield _linked_blocks(rest, [0, rest.num_rows])


def _linked_blocks(rows: pa.Table, edges: list[int]) -> pa.RecordBatch:
    rows = rows.select(["key", "shingles"]).combine_chunks()
    keys, lists = rows.column("key").to_numpy(), rows.column("shingles").combine_chunks()
    offsets = lists.offsets.to_numpy()
    values, places = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    sets = np.split(places, offsets[1:-1] - offsets[0])
    sizes, mark = np.diff(offsets), np.zeros(len(values), bool)
    found = [_links(range(a, b), keys, sets, sizes, mark) for a, b in zip(edges, edges[1:], strict=False)]
    ends = np.array([x for links in found for x in links], np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(keys[ends[:, 0]]), pa.array(keys[ends[:, 1]])], ["a", "b"])


def _links(block: range, keys: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray, mark: np.ndarray) -> list[tuple[int, int]]:
    """Linked lines of a block.

    Breadth first: a line is compared with the lines not reached yet, so a
    group of near copies costs little more than one comparison per line.
    """
    waiting = np.array(block)[np.unique(keys[block.start : block.stop], return_index=True)[1]]
    waiting = waiting[np.argsort(sizes[waiting], kind="stable")]
    found = []
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            own = queue.pop()
            near = (sizes[waiting] >= SIMILARITY * sizes[own] - 1e-9) & (sizes[own] >= SIMILARITY * sizes[waiting] - 1e-9)
            if not near.any():
                continue
            rivals = waiting[near]
            mark[sets[own]] = True
            starts = np.cumsum(sizes[rivals]) - sizes[rivals]
            shared = np.add.reduceat(mark[np.concatenate([sets[i] for i in rivals])].astype(np.int64), starts)
            mark[sets[own]] = False
            hits = rivals[shared >= SIMILARITY * (sizes[rivals] + sizes[own] - shared) - 1e-9]
            found += [(own, x) for x in hits.tolist()]
            queue += hits.tolist()
            waiting = waiting[~np.isin(waiting, hits)]
    return found


def line_links(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Edges (a, b) between keys of different lines: enough to connect all that is at least SIMILARITY alike."""
    different = durable(lines.groupBy("key").agg(F.min(F.struct("doc", "start")).alias("at"), F.first("bands").alias("bands")))
    entries = different.select("key", F.explode("bands").alias("band"))
    shared = durable(
        entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select(
            F.col("band").alias("shared_band"), F.ceil(F.col("n") / BLOCK_LINES).cast("int").alias("parts")
        )
    )
    members = entries.join(shared, F.col("band") == F.col("shared_band")).select("band", "key", "parts")
    # Alike lines share most of their bands: small bands of the same lines are verified once.
    same = (
        members.where("parts = 1").groupBy("band").agg(F.sort_array(F.collect_set("key")).alias("keys"))
        .where(F.size("keys") > 1).groupBy("keys").agg(F.min("band").alias("band"))
    )
    members = durable(
        same.select("band", F.explode("keys").alias("key"), F.lit(1).alias("parts")).union(members.where("parts > 1"))
    )
    # Shingles only of lines that collide with another one.
    spots = (
        members.select("key").distinct().join(different, "key")
        .groupBy(F.col("at.doc").alias("spot_doc")).agg(F.collect_list("at.start").alias("starts"))
    )
    spots = durable(spots)
    ids = spots.select("spot_doc")
    if spots.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    hit = docs.join(ids, F.col("doc") == F.col("spot_doc"), "left_semi").join(spots, F.col("doc") == F.col("spot_doc"))
    sets = durable(hit.select("text", "starts").mapInArrow(_shingles, "key long, shingles array<long>").dropDuplicates(["key"]))
    # A large band is dealt out in parts; every pair of parts meets in one task.
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    dealt = members.withColumn("part", part).select(
        "band", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select("band", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "key")
    blocks = dealt.join(sets, "key").select("band", "low", "high", "key", "shingles")
    block = ["band", "low", "high"]
    return blocks.repartition(*block).sortWithinPartitions(*block).mapInArrow(_linked, "a long, b long")


def resolve(doc: int, spans: list[tuple[int, int, int, bool]]) -> list[tuple[int, int, int]]:
    """Disjoint (start, end, first document) of a document's (start, end, first document, whether a window).

    Neighbouring words of one class are one span. Where classes overlap,
    windows that the document keeps stay whole, then windows that another
    document keeps go, then lines count; of equal rank the least class wins.
    """
    ranked = sorted(spans, key=lambda x: (x[3], x[3] and x[2] == doc, -x[2]))
    classes = np.unique([x[2] for x in spans])
    low = min(x[0] for x in spans)
    own = np.full(max(x[1] for x in spans) - low, -1, np.int64)
    for (start, end, *_), k in zip(ranked, np.searchsorted(classes, [x[2] for x in ranked]).tolist(), strict=True):
        own[start - low : end - low] = k
    edges = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]]).tolist()
    return [(a + low, b + low, int(classes[own[a]])) for a, b in zip(edges, edges[1:], strict=False) if own[a] >= 0]


def _resolved(doc: Column, spans: Column) -> Column:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_doc", pa.int64())]))

    @F.arrow_udf("array<struct<start:int,end:int,first_doc:bigint>>")
    def of_documents(docs: pa.Array, lists: pa.Array) -> pa.Array:
        rows = list(zip(*(x.to_pylist() for x in lists.flatten().flatten()), strict=True))
        at, found, ends = 0, [], [0]
        for own, n in zip(docs.to_pylist(), lists.value_lengths().to_pylist(), strict=True):
            found += resolve(own, rows[at : at + n])
            at += n
            ends.append(len(found))
        columns = zip(*found, strict=True) if found else [()] * 3
        parts = pa.StructArray.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, kind.value_type, strict=True)], fields=list(kind.value_type)
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)

    return of_documents(doc, spans)


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per repeated passage of a document.

    Columns: doc_id, start (word), n_words, class_id (least id of a document
    that holds it or something linked with it) and removed (false in that
    document). Words are cut at ASCII white space, A-Z lower-cased. Every run
    of MIN_WORDS equal words that two documents share is found, by its
    anchored windows (at least WINDOW words of it are in the span), and so is
    every line of MIN_WORDS words that is SIMILARITY alike to one of another
    document. Finds of one class that touch or overlap are one span; spans of
    a document never overlap. Lines are settled first; a window belongs to the
    least document that holds it outside removed lines and stays whole there.
    Up to WINDOW - 1 words at the end of a passage may stand twice where
    classes overlap, none is removed everywhere. Ids must be integers; rows without one are left out, rows of one id are one
    document. Null, empty and short texts have no passage. Other columns are
    not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    paragraphs = durable(rows.mapInArrow(_paragraphs, PARAGRAPHS))
    lines = paragraphs.select("doc", "line_starts", "line_sizes", "line_bands", F.posexplode("line_keys").alias("nth", "key")).select(
        "key", "doc", F.col("line_starts")[F.col("nth")].alias("start"), F.col("line_sizes")[F.col("nth")].alias("n"),
        F.slice("line_bands", F.col("nth") * BANDS + 1, BANDS).alias("bands"),
    )
    roots = components(line_links(rows, lines))
    holders = lines.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    rooted = holders.join(roots, F.col("key") == F.col("node"), "left").select(
        "key", "low", "high", F.coalesce("root", "key").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("low").alias("first_doc"), F.max("high").alias("last_doc")).where(
        "first_doc <> last_doc"
    )
    alike = rooted.join(groups, "root").select(F.col("key").alias("alike_key"), "first_doc")
    near = durable(
        lines.join(alike, F.col("key") == F.col("alike_key"))
        .select("doc", "start", (F.col("start") + F.col("n")).alias("end"), "first_doc", F.lit(False).alias("is_window"))
    )
    windows = paragraphs.select("doc", "window_starts", F.posexplode("window_keys").alias("nth", "key")).select(
        "key", "doc", F.col("window_starts")[F.col("nth")].alias("start")
    )
    several = durable(
        windows.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .where("low <> high").select(F.col("key").alias("several_key"))
    )
    # A window in a removed line goes with it, so that line's document is not the one that keeps the window.
    gone = near.where("first_doc <> doc").groupBy(F.col("doc").alias("gone_doc")).agg(
        F.collect_list(F.struct("start", "end")).alias("gone")
    )
    within = F.exists("gone", lambda x: (x["start"] <= F.col("start")) & (F.col("start") + WINDOW <= x["end"]))
    repeated = durable(
        windows.join(several, F.col("key") == F.col("several_key"), "left_semi")
        .join(gone, F.col("doc") == F.col("gone_doc"), "left")
        .where(~F.coalesce(within, F.lit(False)))
        .select("key", "doc", "start")
    )
    firsts = repeated.groupBy("key").agg(F.min("doc").alias("first_doc"))
    equal = splittable_join(repeated, firsts, ["key"], "inner").select(
        "doc", "start", (F.col("start") + WINDOW).alias("end"), "first_doc", F.lit(True).alias("is_window")
    )
    spans = equal.union(near).groupBy("doc").agg(F.collect_set(F.struct("start", "end", "first_doc", "is_window")).alias("spans"))
    return spans.select("doc", F.inline(_resolved(F.col("doc"), F.col("spans")))).select(
        F.col("doc").alias(doc_id), "start", (F.col("end") - F.col("start")).alias("n_words"),
        F.col("first_doc").alias("class_id"), (F.col("first_doc") != F.col("doc")).alias("removed"),
    )
