"""DuckDB SQL with the same results, for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

EXACT = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text, {WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + 7] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM starts, range(8) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT doc_id, source, text, unnest(lines) AS line FROM d)),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM d GROUP BY source),
frequent AS (
  SELECT source, line FROM (SELECT source, line, count(DISTINCT text) AS n FROM lines GROUP BY source, line) JOIN hosts USING (source)
  WHERE n > 20 AND 100 * n > 5 * texts),
removed AS (
  SELECT doc_id, sum(len(string_split(line, ' '))) AS n_removed_words FROM lines JOIN frequent USING (source, line) GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept, n_removed_words
FROM counts
"""


def matches(name: str, pattern: str, rank: int) -> str:
    """Matches of a pattern with their places, from the pieces between them."""
    return rf"""
{name}_pieces AS (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS pieces FROM d),
{name}_found AS (
  SELECT doc_id, hits[i] AS hit,
    list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT doc_id, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM {name}_pieces)),
{name} AS (SELECT doc_id, '{name}' AS kind, {rank} AS rank, s::BIGINT AS s, (s + length(hit))::BIGINT AS e, hit FROM {name}_found),"""


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{matches("assign", ASSIGN, 0)}
{matches("access", "AKIA[A-Z0-9]+", 1)}
{matches("hex", "[0-9a-f]+", 2)}
{matches("entropy", "[A-Za-z0-9+/_=-]+", 3)}
base AS (
  SELECT * FROM assign WHERE length(regexp_extract(hit, '{ASSIGN}', 2)) >= 12
  UNION ALL SELECT * FROM access WHERE length(hit) >= 18
  UNION ALL SELECT * FROM hex WHERE length(hit) >= 16),
candidates AS (
  SELECT * FROM entropy WHERE length(hit) >= 20 AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')
    AND NOT regexp_full_match(hit, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}')
    AND NOT regexp_matches(lower(hit), 'example|sample|dummy|placeholder|xxxxxxxx|changeme')),
windows AS (SELECT doc_id, s, e, hit, substr(hit, i, 20) AS w, i FROM (SELECT *, unnest(range(1, length(hit) - 18)) AS i FROM candidates)),
letters AS (
  SELECT doc_id, s, i, c, count(*) AS n
  FROM (SELECT doc_id, s, i, unnest(string_split(w, '')) AS c FROM windows) GROUP BY doc_id, s, i, c),
best AS (
  SELECT doc_id, s, max(h) AS h FROM (SELECT doc_id, s, i, sum(-(n / 20.0) * log2(n / 20.0)) AS h FROM letters GROUP BY doc_id, s, i) GROUP BY doc_id, s),
fresh AS (
  SELECT c.* FROM candidates c JOIN best b USING (doc_id, s)
  WHERE round(b.h, 9) >= CASE WHEN regexp_full_match(hit, '[0-9a-fA-F]+') THEN 3.0 WHEN regexp_matches(hit, '[+/_=-]') THEN 3.9 ELSE 3.7 END
    AND NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = c.doc_id AND x.s <= c.s AND c.e <= x.e)),
all_spans AS (SELECT * FROM base UNION ALL SELECT * FROM fresh),
base_text AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS t FROM base GROUP BY doc_id),
all_text AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS t FROM all_spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(b.t, '')) AS base_sha256, coalesce(a.t, '') AS spans
FROM d LEFT JOIN base_text b USING (doc_id) LEFT JOIN all_text a USING (doc_id)
"""

TRIE = """
WITH t AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS n,
    sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'h': h, 'n': n} ORDER BY turn NULLS FIRST, h, n) AS turns FROM t GROUP BY conv_id),
taken AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
    4294967295::BIGINT)) % 9 AS h FROM own),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM taken c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
paths AS (
  SELECT conv_id, len(turns) AS length, d AS depth, turns[d].n AS n,
    md5(array_to_string(list_transform(turns[1:d], lambda x: x.h), '/')) AS id, md5(array_to_string(list_transform(turns[1:d - 1], lambda x: x.h), '/')) AS up
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM whole)),
nodes AS (
  SELECT depth, id, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(max(n), 0) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, id),
children AS (SELECT depth - 1 AS depth, up AS id, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth, up),
full_nodes AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c USING (depth, id) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.id = n.up),
below AS (
  SELECT a.depth, a.id, sum(n.saved) AS saved_tokens, count(*) FILTER (n.n_children = 0) AS n_leaves
  FROM full_nodes n JOIN paths o ON o.conv_id = n.conv_id AND o.depth = n.depth JOIN paths a ON a.conv_id = o.conv_id AND a.depth <= o.depth
  GROUP BY a.depth, a.id)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b USING (depth, id)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, a.r, b.vec_id, b.r AS other, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op5_exact_dedup": EXACT, "op7_quality_rules": RULES, "op8_secrets": SECRETS, "op11_prefix_trie": TRIE, "op12_top_k": TOP_K}
