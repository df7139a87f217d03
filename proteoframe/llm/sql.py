"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from proteoframe.llm.base import WORD
from proteoframe.llm.lexical import TERM
from proteoframe.llm.licenses import COPYRIGHT_LINE, KNOWN, LOWER, OTHER, SPELLINGS, UPPER


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


MIXING = f"""
WITH d AS (
  SELECT doc_id, source, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         coalesce(len(regexp_extract_all(text, {_literal(WORD)})), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM d GROUP BY source),
w AS (SELECT *, ((rk - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3 / ((rk - 1) % 3 + 1)::DOUBLE AS cost FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER
             (ORDER BY cost, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cost, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM w),
t AS (SELECT *, least(source_size * 3.0::DOUBLE, max(lv) OVER () * weight) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         round(p.target)::BIGINT - p.whole * p.source_size AS pass,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       whole * size + greatest(0, least(size, pass - before)) AS taken
FROM r"""

NEAREST = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM p QUALIFY rank <= 5"""


def _single(text: str) -> str:
    """Canonical but for phrases, lines kept apart."""
    out = (f"regexp_replace(regexp_replace(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
           f"{_literal('(?m)' + COPYRIGHT_LINE)}, '', 'g'), {_literal(OTHER)}, ' ', 'g')")
    return _spelled(out, phrases=False)


def _spelled(text: str, phrases: bool) -> str:
    for old, new in SPELLINGS:
        if (" " in old) == phrases:
            text = f"replace({text}, '{old}', '{new}')"
    return text


def _whole(folded: str) -> str:
    return _spelled(f"trim(regexp_replace({folded}, '[ \\n]+', ' ', 'g'))", phrases=True)


LICENSES = f"""
WITH known(license_id, text) AS (VALUES {", ".join(f"({_literal(k)}, {_literal(t)})" for k, t in sorted(KNOWN.items()))}),
kf AS (SELECT license_id, {_whole(_single("text"))} AS form FROM known),
k AS (SELECT sha256(form) AS digest, min(license_id) AS license_id FROM kf WHERE form <> '' GROUP BY 1),
f AS (SELECT doc_id, {_single("text")} AS folded FROM documents),
u AS (
  SELECT doc_id, 0::BIGINT AS line_no, {_whole("folded")} AS form FROM f
  UNION ALL
  SELECT doc_id, i::BIGINT, trim(lines[i]) FROM (
    SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
      SELECT doc_id, string_split({_spelled("folded", phrases=True)}, chr(10)) AS lines FROM f))),
g AS (SELECT doc_id, line_no, CASE WHEN form <> '' THEN sha256(form) END AS digest FROM u)
SELECT doc_id, line_no, g.digest, license_id
FROM g LEFT JOIN k ON g.digest = k.digest
WHERE line_no = 0 OR license_id IS NOT NULL"""


def _record(html: str) -> str:
    nl = "chr(13) || chr(10)"
    return (f"'WARC/1.1' || {nl} || 'WARC-Type: response' || {nl} || 'WARC-Target-URI: ' || coalesce(url, '') || {nl} || "
            f"'WARC-Record-ID: <urn:record:' || page_id || '>' || {nl} || 'Content-Length: ' || "
            f"octet_length(encode(coalesce({html}, ''))) || {nl} || {nl} || coalesce({html}, '') || {nl} || {nl}")


FIXITY = f"""
WITH a AS (
  SELECT page_id, page_id // 1000 AS file, {_record("html")} AS ra,
         {_record("CASE WHEN page_id % 97 = 5 THEN '?' || substr(html, 2) ELSE html END")} AS rb
  FROM pages),
b AS (
  SELECT *, coalesce(sum(octet_length(encode(ra))) OVER (PARTITION BY file ORDER BY page_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM a)
SELECT file, "offset", "offset" // 65536 AS range,
       CASE WHEN page_id % 211 = 7 THEN 'missing' ELSE 'changed' END AS kind,
       octet_length(encode(ra)) AS length_a,
       CASE WHEN page_id % 211 <> 7 THEN octet_length(encode(rb)) END AS length_b,
       sha256(ra) AS digest_a, CASE WHEN page_id % 211 <> 7 THEN sha256(rb) END AS digest_b
FROM b WHERE page_id % 211 = 7 OR ra <> rb"""


def _escaped(text: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(replace(coalesce({text}, ''), '~', '~0'), "
            r"'<([|/s<])', '<~1\1', 'g'), '<([|/s<])', '<~1\1', 'g'), '\[(/?INST\])', '[~1\1', 'g')")


CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, length('<|' || replace({_escaped("role")}, '|>', '|~1>') || '|>' || chr(10))
            + length({_escaped("text")}) + length('<|end|>') + 1 AS width,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n FROM c),
e AS (SELECT *, sum(width) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""

LEXICAL = f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), {_literal(TERM)})) AS term
  FROM documents),
f AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY r, term),
d AS (SELECT r, sum(tf)::BIGINT AS n FROM f GROUP BY r),
a AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), {_literal(TERM)})) AS term
  FROM benchmark),
w AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM f, a WHERE term IN (SELECT term FROM q) GROUP BY term, nn),
s AS (
  SELECT item_id, f.r, any_value(f.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN d ON d.r = f.r, a
  GROUP BY item_id, f.r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 AND item_id IS NOT NULL QUALIFY rank <= 50"""

#: CRC-32 of a conversation's decimal id: each byte is mixed in and followed by eight shifts (-1).
_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

TRIE = f"""
WITH own AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS width,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS i FROM own),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS family, {_CRC32} % 6 AS h FROM own),
r AS (
  SELECT c.conv_id, 0 AS part, i, width, digest FROM c JOIN k ON k.conv_id = family AND i < h
  UNION ALL SELECT c.conv_id, 1, i, width, digest FROM c JOIN k ON k.conv_id = c.conv_id AND i >= h),
p AS (
  SELECT conv_id, width, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT path, any_value(depth) AS depth, any_value(width) AS width, min(conv_id) AS conv_id, count(*) AS n_convs
      FROM p GROUP BY path),
e AS (SELECT path, string_agg(conv_id, ',' ORDER BY conv_id) AS ends
      FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path),
k2 AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k2 USING (path)),
s AS (SELECT v.path, sum((u.n_convs - 1) * u.width) AS saved_tokens, count(*) FILTER (u.n_children = 0) AS n_leaves
      FROM f v JOIN f u ON starts_with(u.path, v.path) GROUP BY v.path)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM f JOIN s USING (path) LEFT JOIN e USING (path)
LEFT JOIN n up ON f.depth > 0 AND up.path = left(f.path, length(f.path) - 64)"""

SQL: dict[str, str] = {
    "op2_mixing": MIXING,
    "op3_nearest": NEAREST,
    "op5_license_scan": LICENSES,
    "op6_fixity_audit": FIXITY,
    "op7_chat_format": CHAT,
    "op11_lexical_search": LEXICAL,
    "op13_prefix_trie": TRIE,
}
