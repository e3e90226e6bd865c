"""DuckDB SQL for the operators that SQL can express on whole tables.

The others are held against brute force, round trips or held-out accuracy in the tests: choices that
are not unique (op7), learned ones (op5, op9), approximate ones (op8), labels found by voting (op2),
tokenizers (op10).
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SOLID = r"[^\x20\x09-\x0D]+"

WARC = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), kept AS (
    SELECT payload_bytes, payload_digest, max(page_id) AS kept
    FROM payloads WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM payloads LEFT JOIN kept USING (payload_bytes, payload_digest)
"""


def _jaccard(percent: int, result: str) -> str:
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_words("text", SOLID)} AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * n_both >= {percent} * (a.n + b.n - n_both)
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x
)
SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, {result}
FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
"""


JACCARD = _jaccard(75, "component_id")
FOREST = _jaccard(85, "component_id, documents.doc_id = component_id AS kept")

DECONTAMINATE = f"""
WITH doc_words AS (
    SELECT doc_id, {_words("text", ALNUM)} AS w FROM documents
), item_words AS (
    SELECT item_id, {_words("text", ALNUM)} AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT size FROM item_windows
), doc_windows AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc_words, sizes WHERE len(w) >= size)
), hits AS (
    SELECT DISTINCT doc_id, i, d.size, item_id FROM doc_windows d JOIN item_windows t ON d.win = t.win AND d.size = t.size
), places AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM hits))
    GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: The 256 steps that make the CRC-32 of a short ASCII text; ``_crc`` needs ``crc`` among its tables.
CRC_TABLE = """crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS steps
)"""


def _crc(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda c, b: xor(steps[(xor(c, b) % 256) + 1], c // 256)))"""


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE}, leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS leaf,
           CASE WHEN {_crc("doc_id::VARCHAR")} % 3 = 0
                THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf("text")} END AS shown
    FROM documents, crc
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), low AS (
    SELECT tree, 0 AS level, i, n, leaf AS digest FROM placed
    UNION ALL
    SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
    FROM low WHERE n > 1 GROUP BY tree, level, i // 8, n
), subroots AS (
    SELECT tree, level AS height, digest, row_number() OVER (ORDER BY tree) - 1 AS t, count(*) OVER () AS trees
    FROM low WHERE n = 1
), high AS (
    SELECT 0 AS level, t AS i, trees AS n, digest FROM subroots
    UNION ALL
    SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
    FROM high WHERE n > 1 GROUP BY level, i // 8, n
), sides AS (
    SELECT p.tree, p.i, low.level AS step, string_agg(digest, '' ORDER BY low.i) FILTER (low.i < p.i >> (3 * level)) AS l,
           string_agg(digest, '' ORDER BY low.i) FILTER (low.i > p.i >> (3 * level)) AS r
    FROM placed p JOIN low ON low.tree = p.tree AND low.n > 1 AND low.i // 8 = p.i >> (3 * level + 3)
    GROUP BY p.tree, p.i, low.level
    UNION ALL
    SELECT p.tree, p.i, height + high.level, string_agg(high.digest, '' ORDER BY high.i) FILTER (high.i < t >> (3 * high.level)),
           string_agg(high.digest, '' ORDER BY high.i) FILTER (high.i > t >> (3 * high.level))
    FROM placed p JOIN subroots s USING (tree) JOIN high ON high.n > 1 AND high.i // 8 = t >> (3 * high.level + 3)
    GROUP BY p.tree, p.i, height, high.level
), folded AS (
    SELECT tree, i, 0 AS step, shown AS node FROM placed
    UNION ALL
    SELECT f.tree, f.i, f.step + 1, sha256(coalesce(l, '') || node || coalesce(r, ''))
    FROM folded f JOIN sides s ON s.tree = f.tree AND s.i = f.i AND s.step = f.step
), ends AS (
    SELECT tree, i, max_by(node, step) AS folded_root FROM folded GROUP BY ALL
), proof AS (
    SELECT tree, i, string_agg(coalesce(l, '') || coalesce(r, ''), '' ORDER BY step) AS siblings FROM sides GROUP BY ALL
)
SELECT doc_id, leaf, s.digest AS subroot, high.digest AS root,
       sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = high.digest AS verified
FROM high, placed JOIN subroots s USING (tree) JOIN ends USING (tree, i) LEFT JOIN proof USING (tree, i)
WHERE high.n = 1
"""

TRIE = f"""
WITH {CRC_TABLE}, named AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, chars, name, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) - 1 AS i FROM named
), sizes AS (
    SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc("conv_id::VARCHAR")} % 6 AS h FROM sizes, crc
), turns AS (
    SELECT c.conv_id, i AS pos, name, chars FROM convs c JOIN own ON own.conv_id = base WHERE i < h
    UNION ALL
    SELECT c.conv_id, least(h, coalesce(n, 0)) + i - h, name, chars
    FROM convs c LEFT JOIN sizes ON sizes.conv_id = base JOIN own ON own.conv_id = c.conv_id WHERE i >= h
), paths AS (
    SELECT conv_id, pos + 1 AS depth, chars, sha256(string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS node FROM turns
), members AS (
    SELECT conv_id, depth, chars, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS up FROM paths
    UNION ALL
    SELECT conv_id, 0, 0, '', NULL FROM convs
), nodes AS (
    SELECT node, any_value(up) AS up, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs
    FROM members GROUP BY node
), children AS (
    SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up
), below AS (
    SELECT DISTINCT v.node, w.node AS other FROM members v JOIN members w ON v.conv_id = w.conv_id AND w.depth >= v.depth
), sums AS (
    SELECT below.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
    FROM below JOIN nodes ON nodes.node = other LEFT JOIN children ON children.node = other GROUP BY below.node
), ends AS (
    SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM members JOIN (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id) USING (conv_id, depth) GROUP BY node
)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN ends USING (node)
LEFT JOIN nodes above ON above.node = nodes.up
"""

ORACLES = {
    "op3_warc": WARC,
    "op4_jaccard_join": JACCARD,
    "op6_decontaminate": DECONTAMINATE,
    "op11_merkle": MERKLE,
    "op12_lsh_forest": FOREST,
    "op13_prefix_trie": TRIE,
}
