"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH d AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
    SELECT doc_id, p, lines[p] AS line,
        translate(trim(lines[p], {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS p FROM d)
), c AS (
    SELECT line_key, max(doc_id) AS keeper FROM l
    WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), j AS (
    SELECT l.*, c.keeper IS NOT NULL AND c.keeper <> l.doc_id AS gone FROM l LEFT JOIN c USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

QUALITY_RULES = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), w AS (
    SELECT doc_id, p, words[p:p + 7] AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM d WHERE len(words) >= 8)
), r AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1
), c AS (
    SELECT doc_id, count(DISTINCT q) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM r) GROUP BY doc_id
), m AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
        length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN c USING (doc_id)
), f AS (
    SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
        + 4 * (n_symbols * 10 > n_words * 3)::BIGINT + 8 * (n_dup_lines * 2 > n_lines)::BIGINT
        + 16 * (word_chars < n_words * 2)::BIGINT + 32 * (word_chars > n_words * 20)::BIGINT
        + 64 * (n_exclaims * 10 > n_words * 3)::BIGINT AS failed
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failed & 3 <> 0 AS base_failed, failed & 15 = 0 AS kept, failed
FROM f
"""

_LEAF = " || ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars")
)


def _crc32(column: str) -> str:
    """CRC-32 of a number as decimal text, bit by bit: each character, then eight shifts (marked 256)."""
    steps = f"flatten(list_transform(regexp_extract_all({column}::VARCHAR, '.'), lambda ch: [ord(ch)::BIGINT] || [256, 256, 256, 256, 256, 256, 256, 256]))"
    step = "CASE WHEN e < 256 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce([4294967295] || {steps}, lambda c, e: {step}), 4294967295)"


def _levels(name: str, leaves: str) -> str:
    """Nodes (l, g, p, h) of trees: every three neighbours of a level make one of the next, until one remains."""
    return f"""{name}(l, g, p, h) AS (
    SELECT 0, g, p, h FROM {leaves}
    UNION ALL
    SELECT l + 1, g, p // 3, sha256(string_agg(h, '' ORDER BY p))
    FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}) WHERE n > 1 GROUP BY l, g, p // 3
)"""


def _folds(name: str, starts: str, nodes: str) -> str:
    """Paths (row, l, g, p, h, proof): the leaf's digest carried up, the siblings put one after the other."""
    return f"""{name}(row, l, g, p, h, proof) AS (
    SELECT row, 0, g, p, h, proof FROM {starts}
    UNION ALL
    SELECT a.row, a.l + 1, a.g, a.p // 3,
        sha256(string_agg(CASE WHEN b.p = a.p THEN a.h ELSE b.h END, '' ORDER BY b.p)),
        a.proof || coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p <> a.p), '')
    FROM {name} a JOIN {nodes} b ON b.g = a.g AND b.l = a.l AND b.p // 3 = a.p // 3
    WHERE EXISTS (FROM {nodes} c WHERE c.g = a.g AND c.l = a.l + 1)
    GROUP BY a.row, a.l, a.g, a.p, a.proof
)"""


def _ends(folds: str) -> str:
    return f"(SELECT * FROM {folds} QUALIFY l = max(l) OVER (PARTITION BY row))"


MERKLE_MANIFEST = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
        sha256({_LEAF} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256({_LEAF} || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS changed
    FROM documents
), r AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
        row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS row FROM d
), own AS (
    SELECT row, g, p, leaf AS h, '' AS proof FROM r
), {_levels("low", "own")}, subroots AS (
    SELECT 0 AS g, g AS p, h FROM low QUALIFY l = max(l) OVER (PARTITION BY g)
), {_levels("high", "subroots")}, x AS (
    SELECT row, g, p, CASE WHEN {_crc32('doc_id')} % 2 = 0 THEN changed ELSE leaf END AS h, '' AS proof FROM r
), {_folds("low_path", "x", "low")}, y AS (
    SELECT row, 0 AS g, g AS p, h, proof FROM {_ends("low_path")}
), {_folds("high_path", "y", "high")}, z AS (
    SELECT h AS root FROM high QUALIFY l = max(l) OVER ()
)
SELECT r.doc_id, r.leaf, s.h AS subroot, z.root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = z.root AS verified
FROM r JOIN subroots s ON s.p = r.g JOIN {_ends("high_path")} e ON e.row = r.row, z
"""

EXACT_TOP_K = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 20
"""
