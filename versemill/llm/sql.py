"""SQL for those dealt queries that SQL can express; DuckDB runs it on the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

# Eight groups of five hexadecimal digits, each written as four digits to the base 32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_GROUPS = " || ".join(
    f"substr('{_BASE32}', 1 + (((CAST('0x' || substr(h, {at}, 5) AS BIGINT)) >> {shift}) & 31)::INT, 1)"
    for at in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)

SQL["op3_warc_round_trip"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT html, min(page_id) AS keep FROM p GROUP BY html)
SELECT page_id,
       strlen(p.html) AS payload_bytes,
       {_GROUPS} AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM p JOIN first ON p.html = first.html
"""

SQL["op4_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM texts
"""

SQL["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS grams
  FROM w
),
sizes AS (SELECT doc_id, len(grams) AS n FROM sets),
g AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * both_n >= 80 * (x.n + y.n - both_n)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION
  SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.other
),
roots AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN roots ON roots.id = sizes.doc_id
"""

SQL["op6_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS run
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
),
first AS (SELECT run, min(doc_id) AS keep FROM windows GROUP BY run),
gone AS (SELECT doc_id, i FROM windows JOIN first USING (run) WHERE doc_id > keep),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
covered AS (
  SELECT words.doc_id, words.i, word,
         coalesce(max(CASE WHEN gone.i IS NOT NULL THEN 1 ELSE 0 END)
           OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS cut
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i
),
left_over AS (
  SELECT doc_id, count(*) AS n_words, sum(cut) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE cut = 0), '') AS kept
  FROM covered GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN left_over ON documents.doc_id = left_over.doc_id
"""

SQL["op8_embedding_near_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION
  SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other
),
roots AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id JOIN roots ON roots.id = vec_id
"""


# CRC-32 of decimal numbers, byte by byte over a table made from the polynomial.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, bit:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) t(i)
)"""


def _crc(number: str) -> str:
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), {step}), 4294967295::BIGINT)"


def _digest(*columns: str) -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    return "sha256(" + " || ".join(field(c) for c in columns) + ")"


def _levels(source: str, group: str) -> str:
    """All levels of the trees over the ``nodes`` of each ``group``."""
    pair = "lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))"
    return f"""
  SELECT {group}, 0 AS level, nodes FROM {source}
  UNION ALL
  SELECT {group}, level + 1, list_transform(range((len(nodes) + 1) // 2), {pair}) FROM {{self}} WHERE len(nodes) > 1"""


# A step of a proof: the sibling, and whether it stands on the left.
_PATH = "list({{s: nodes[1 + xor({at} >> level, 1)], l: (({at} >> level) & 1) = 1}} ORDER BY level)"

SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT *, {_digest("doc_id", "source", "lang", "n_chars", "text")} AS leaf, coalesce('=' || lang, '') AS g,
         {_digest("doc_id", "source", "lang", "(n_chars + 1)", "text")} AS altered
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
lists AS (SELECT g, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY g),
levels AS ({_levels("lists", "g").format(self="levels")}),
subroots AS (SELECT g, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS place FROM levels WHERE len(nodes) = 1),
upper_list AS (SELECT 0 AS t, list(subroot ORDER BY place) AS nodes FROM subroots),
upper_levels AS ({_levels("upper_list", "t").format(self="upper_levels")}),
root AS (SELECT nodes[1] AS root FROM upper_levels WHERE len(nodes) = 1),
below AS (
  SELECT g, i, {_PATH.format(at="i")} AS path FROM placed JOIN levels USING (g) WHERE len(nodes) > 1 GROUP BY g, i
),
above AS (
  SELECT g, {_PATH.format(at="place")} AS path FROM subroots, upper_levels WHERE len(nodes) > 1 GROUP BY g
),
proven AS (
  SELECT doc_id, leaf, subroot, list_concat(coalesce(below.path, []), coalesce(above.path, [])) AS path,
         CASE WHEN {_crc("doc_id")} % 7 = 0 AND n_chars IS NOT NULL THEN altered ELSE leaf END AS now
  FROM placed CROSS JOIN crc_table JOIN subroots USING (g)
  LEFT JOIN below ON below.g = placed.g AND below.i = placed.i
  LEFT JOIN above ON above.g = placed.g
),
done AS (
  SELECT doc_id, leaf, subroot, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.s), ''), '')) AS proof_sha256,
         list_reduce(list_prepend({{s: now, l: false}}, path), lambda a, x: {{s: sha256(
           CASE WHEN x.s IS NULL THEN a.s WHEN x.l THEN x.s || a.s ELSE a.s || x.s END), l: false}}).s AS folded_root
  FROM proven
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done CROSS JOIN root
"""

SQL["op13_prefix_trie"] = f"""
WITH {_CRC_TABLE},
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS d
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own) CROSS JOIN crc_table),
heads AS (SELECT c.conv_id, c.h, count(own.d) AS head FROM convs c LEFT JOIN own ON own.conv_id = c.base AND own.d <= c.h GROUP BY ALL),
rebuilt AS (
  SELECT c.conv_id, own.d, own.role, own.text FROM convs c JOIN own ON own.conv_id = c.base AND own.d <= c.h
  UNION ALL
  SELECT own.conv_id, own.d - heads.h + heads.head, own.role, own.text FROM own JOIN heads USING (conv_id) WHERE own.d > heads.h
),
marks AS (SELECT conv_id, list(md5(strlen(role) || ':' || role || text) ORDER BY d) AS ms, list(length(text) ORDER BY d) AS ps FROM rebuilt GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(ms, []) AS ms, coalesce(ps, []) AS ps FROM convs LEFT JOIN marks USING (conv_id)),
prefixes AS (
  SELECT conv_id, d AS depth, len(ms) AS n_turns, md5(array_to_string(ms[1:d], '')) AS prefix, coalesce(ps[d], 0) AS points
  FROM (SELECT *, unnest(range(len(ms) + 1)) AS d FROM whole)
),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n_turns = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, prefix
),
parents AS (
  SELECT n.depth, n.prefix, p.prefix AS above, up.conv_id AS parent_conv_id
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
  JOIN nodes up ON up.depth = p.depth AND up.prefix = p.prefix
),
children AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n_children FROM parents GROUP BY ALL),
counted AS (SELECT *, (n_convs - 1) * points AS saved, n_children IS NULL AS leaf FROM nodes LEFT JOIN children USING (depth, prefix)),
under AS (
  SELECT p.depth, p.prefix, sum(leaf::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY ALL
)
SELECT c.conv_id, c.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM counted c JOIN under u ON u.depth = c.depth AND u.prefix = c.prefix
LEFT JOIN parents p ON p.depth = c.depth AND p.prefix = c.prefix
"""
