"""Plain versions that the operators are held against, and odd tables."""

import re

import duckdb
import xxhash

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
# (doc_id, text): nulls, empty and very long texts, ties, repeated rows.
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "one"), (5, "one"), (None, "a line that nobody names at all"),
    (6, "A line that NOBODY names at all \n é"), (7, " a line that nobody names at all"), (8, "日本語のテキスト"),
    (9, "a line that nobody names at all\n\na line that nobody names at all"), (9, "one"),
]


def rows_of(table, columns, sf=SF):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{table}.parquet'").fetchall()


def documents(sf=SF):
    return rows_of("documents", "doc_id, text", sf)


def odd_frame(spark, rows=None):
    """Odd rows with extra columns whose names the operators use themselves."""
    clash = ["key", "fp", "shard", "slot", "kept_text", "n_lines", "n_dropped", "words", "t", "item_id", "doc", "start"]
    clash += ["loss", "loss_keys", "loss_doc", "kept", "kept_doc", "kept_id", "whole_text", "gone_id", "leak_doc", "label", "label_id"]
    clash += ["component_id", "class_fp", "root", "least_id", "spots", "spot_doc", "hashes", "n", "width", "line_key", "common_key"]
    data = [(i, t, *["x"] * len(clash)) for i, t in (ODD if rows is None else rows)]
    return spark.createDataFrame(data, "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    own = words(lower(text))
    n = min(3, len(own))
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + n]).encode(), 42) for i in range(len(own) - n + 1)] if own else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def near_classes(docs, radius=2):
    """(id, fingerprint, smallest id reachable) of every row, by all pairs of different fingerprints."""
    prints = [(i, fingerprint(t)) for i, t in docs]
    different = sorted({f for _, f in prints})
    sets = Sets()
    for k, f in enumerate(different):
        for g in different[k + 1 :]:
            if (f ^ g).bit_count() <= radius:
                sets.join(f, g)
    least = {}
    for i, f in prints:
        root = sets.find(f)
        if i is not None:
            least[root] = min(i, least.get(root, i))
    return [(i, f, least.get(sets.find(f))) for i, f in prints]


def line_key(line):
    bare = lower(line.strip(SPACES))
    return bare if len(bare) >= 20 else None


def without_lines(docs):
    """(id, number of lines, dropped lines, kept text) of every row."""
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if line_key(line):
                holders.setdefault(line_key(line), set()).add(i)
    keeper = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    found = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if line_key(x) not in keeper or keeper[line_key(x)] == i]
        found.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return found


def shingle_counts(own, width=5):
    from collections import Counter

    width = min(width, len(own))
    return Counter(tuple(own[k : k + width]) for k in range(len(own) - width + 1)) if own else Counter()


def leaks(docs, items, similarity=0.8):
    """{(doc id, item id): best similarity} by every window of every document."""
    own_items = {}
    for item, text in items:
        w = tuple(words((text or "").lower()))
        if w:
            own_items[w] = min(item, own_items.get(w, item))
    found = {}
    for i, text in docs:
        w = words((text or "").lower())
        have = set(w)
        for item_words, item in own_items.items():
            if len(have.intersection(item_words)) < 0.5 * len(set(item_words)):
                continue
            want = shingle_counts(item_words)
            width = min(5, len(item_words))
            for at in range(max(1, len(w) - len(item_words) + 1)):
                got = shingle_counts(w[at : at + len(item_words)], width)
                shared = (want & got).total()
                alike = shared / ((want | got).total() or 1)
                if alike >= similarity:
                    found[i, item] = max(alike, found.get((i, item), 0))
    return found


def quality(text):
    own = words(text)
    places = {}
    for k in range(len(own) - 7):
        places.setdefault(tuple(own[k : k + 8]), []).append(k)
    covered = {q for p in places.values() if len(p) > 1 for k in p for q in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
    )
