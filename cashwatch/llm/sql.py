"""DuckDB SQL for the rows of the queries that SQL can state."""

from __future__ import annotations

# Every node is a prefix of some conversation; what a subtree holds is counted over the paths of
# the smallest members. The checksum is the usual one, bit by bit.
_TRIE = """
WITH named AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), digested AS (
    SELECT conv_id, turn, md5(length(role) || ':' || role || text) AS digest, length(text) AS len FROM named
), turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS p FROM digested
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1),
            lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, zero: xor(a >> 1, 3988292384 * (a & 1))))) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), head AS (
    SELECT c.conv_id, t.p, t.digest, t.len FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p <= c.h
), shared AS (
    SELECT c.conv_id, any_value(c.h) AS h, count(x.p) AS n FROM convs c LEFT JOIN head x USING (conv_id) GROUP BY 1
), whole AS (
    SELECT * FROM head
    UNION ALL
    SELECT t.conv_id, t.p - s.h + s.n, t.digest, t.len FROM turns t JOIN shared s USING (conv_id) WHERE t.p > s.h
), paths AS (
    SELECT conv_id, p AS d, len,
        md5(string_agg(digest, '/') OVER (PARTITION BY conv_id ORDER BY p)) AS node,
        p = max(p) OVER (PARTITION BY conv_id) AS is_end
    FROM whole
    UNION ALL
    SELECT conv_id, 0, 0, md5(''), conv_id NOT IN (SELECT conv_id FROM whole) FROM convs
), stepped AS (
    SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent FROM paths
), nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(d) AS d, any_value(len) AS len, min(conv_id) AS conv_id, count(*) AS n,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '') AS ends
    FROM stepped GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), subtrees AS (
    SELECT a.node, count(*) FILTER (WHERE k.n IS NULL) AS leaves, sum((m.n - 1) * m.len) AS saved
    FROM nodes m JOIN paths a ON a.conv_id = m.conv_id AND a.d <= m.d LEFT JOIN children k ON k.node = m.node
    GROUP BY a.node
)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children,
    s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.node = n.parent LEFT JOIN children k ON k.node = n.node JOIN subtrees s ON s.node = n.node
"""

_TERMS = r"""unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

_RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, text FROM documents),
found AS (SELECT doc, {_TERMS} AS term FROM docs),
counted AS (SELECT doc, term, count(*) AS tf FROM found GROUP BY doc, term),
lengths AS (SELECT doc, sum(tf)::BIGINT AS n FROM counted GROUP BY doc),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS occurrences FROM lengths),
wanted AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, corpus WHERE term IN (SELECT term FROM wanted) GROUP BY term
), scaled AS (SELECT doc, 10 + (90 * n * documents) // occurrences AS m FROM lengths, corpus),
scores AS (
    SELECT q.item_id, c.doc, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * s.m)))::BIGINT AS score
    FROM wanted q JOIN weights w USING (term) JOIN counted c USING (term) JOIN scaled s USING (doc)
    GROUP BY q.item_id, c.doc
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scores JOIN docs USING (doc) WHERE score > 0
QUALIFY rank <= 10
"""

_JACCARD = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM cut
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * c >= 80 * (a.n + b.n - c)
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reached r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

# Exact pairs. The query's index is approximate, but tables of few vectors are one cell of it.
_NEAR_VECTORS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
    WHERE len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND list_max(list_transform(v, lambda c: abs(c))) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.95
), reached AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings
    UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
), counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(any_value(n), 0) AS n_links, min(r.y) AS component_id, e.vec_id = min(r.y) AS kept
FROM embeddings e JOIN reached r ON r.x = e.vec_id LEFT JOIN counted c ON c.x = e.vec_id GROUP BY e.vec_id
"""

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard": _JACCARD,
    "op7_embedding_near_dedup": _NEAR_VECTORS,
    "op12_conversation_trie": _TRIE,
    "op13_ranked_search": _RANKED,
}
