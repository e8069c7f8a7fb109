"""DuckDB SQL for the registered queries, over the given tables."""

from __future__ import annotations

# Words that the word index leaves out.
_STOP = """'a', 'an', 'and', 'are', 'as', 'at', 'be', 'by', 'for', 'from', 'in', 'is', 'it', 'of', 'on', 'or', 'that', 'the',
  'to', 'was', 'were', 'with'"""
_SCORE = "frequency * 10 + 1000 - depth * 5"


def _entities(text: str) -> str:
    """The entities that occur in the pages, replaced."""
    return (
        f"replace(replace(replace(regexp_replace({text}, '&amp;?', '&', 'g'), '&copy;', '©'), "
        "'&middot;', '·'), '&quot;', '\"')"
    )


_TITLE = "trim(" + _entities("regexp_extract(html, '<title>([^<]*)', 1)") + ")"
_VISIBLE = _entities(
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
    r"'(?s)<(script|style|noscript)\b[^>]*>.*?</(script|style|noscript)>', '', 'g'), "
    r"'(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '<!?[a-zA-Z/][^>]*$', '')"
)


def _base(source: str = "pages") -> str:
    """Pages with url, origin, depth, title and visible text."""
    return f"""base AS (
  SELECT page_id, regexp_replace(url, '#.*$', '') AS url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS host_key,
         host_key || '/' AS origin_url, (page_id % 4)::INTEGER AS depth, page_id % 10 AS kind,
         html, {_TITLE} AS title, {_VISIBLE} AS visible
  FROM {source}
)"""


_OUTCOMES = """rows AS (
  SELECT *, CASE WHEN kind = 7 THEN 404 WHEN kind = 9 THEN 0 ELSE 200 END AS status_code,
         CASE WHEN kind = 7 THEN 'HTTPError: Not Found' WHEN kind = 9 THEN 'timed out' END AS error,
         CASE WHEN kind IN (7, 9) THEN 'error' ELSE 'success' END AS outcome,
         CASE WHEN kind IN (7, 8, 9) THEN '' ELSE title END AS shown_title,
         CASE WHEN kind IN (7, 9) THEN '' WHEN kind = 8 THEN left(html, 1000) ELSE visible END AS content
  FROM base
)"""

_LINKS = """links AS (
  SELECT url AS src, origin_url, depth, unnest(generate_series(0, len(hrefs) - 1))::INTEGER AS pos,
         host_key || unnest(hrefs) AS dst
  FROM (SELECT *, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM base) WHERE len(hrefs) > 0
)"""


def _fold(text: str) -> str:
    return f"strip_accents(lower({text}))"


def _n_tokens(text: str) -> str:
    return rf"len(regexp_extract_all({_fold(text)}, '[\p{{L}}\p{{N}}\p{{Co}}]+'))::INTEGER"


def _postings(text: str, source: str, name: str = "postings") -> str:
    return f"""{name} AS (
  SELECT word, url, origin_url, depth, count(*)::INTEGER AS frequency
  FROM (SELECT url, origin_url, depth, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS word FROM {source})
  WHERE length(word) > 1 AND word NOT IN ({_STOP}) GROUP BY ALL
)"""


_DOCUMENTS = """docs AS (
  SELECT 'doc://' || doc_id AS url, 'src://' || source AS origin_url, (doc_id % 4)::INTEGER AS depth,
         '' AS title, text AS visible FROM documents
)"""

_PAGE_POSTINGS = f"WITH {_base()}, {_postings('visible', 'base')}"
_DOC_POSTINGS = f"WITH {_DOCUMENTS}, {_postings('visible', 'docs')}"
_OUTCOME_POSTINGS = f"WITH {_base()}, {_OUTCOMES}, {_postings('content', '(FROM rows WHERE error IS NULL)')}"
_ALL_COLUMNS = "SELECT word, url, origin_url, depth, frequency FROM postings"


def _word_search(head: str, word: str) -> str:
    return f"{head} SELECT url, {_SCORE} AS score, frequency, depth FROM postings WHERE word = '{word}'"


_WORD_ORDER = "score DESC, url, frequency DESC, depth"

_BATCH = f"""{_DOC_POSTINGS},
asked AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM benchmark
),
scored AS (SELECT word, url, {_SCORE} AS score, frequency, depth FROM postings),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY {_WORD_ORDER})::INTEGER AS position FROM scored)
SELECT word AS query_id, position, url, score, frequency, depth FROM ranked JOIN asked USING (word) WHERE position <= 25"""

_AUDIT = f"""{_PAGE_POSTINGS},
often AS (SELECT word FROM postings GROUP BY word HAVING count(DISTINCT url) > 1),
scored AS (SELECT word, url, {_SCORE} AS score, frequency, depth FROM postings JOIN often USING (word)),
reported AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY {_WORD_ORDER})::INTEGER AS position FROM scored),
manual AS (
  SELECT word, url AS manual_url, 1000 + 10 * frequency - 5 * depth AS manual_score,
         row_number() OVER (PARTITION BY word ORDER BY 1000 + 10 * frequency - 5 * depth DESC, url, frequency DESC)::INTEGER AS position
  FROM postings JOIN often USING (word)
),
checked AS (
  SELECT word, position, manual_url, manual_score, url, score, score = manual_score AS score_ok, url = manual_url AS order_ok,
         url IS NOT NULL AND frequency IS NOT NULL AND depth IS NOT NULL AS fields_ok
  FROM manual JOIN reported USING (word, position) WHERE position <= 3
)
SELECT *, score_ok AND order_ok AND fields_ok AS passed FROM checked"""

_JSON = f"""{_PAGE_POSTINGS},
ordered AS (
  SELECT url, {_SCORE} AS score, frequency, depth FROM postings WHERE word = 'ing'),
numbered AS (SELECT *, row_number() OVER (ORDER BY {_WORD_ORDER}) AS place FROM ordered)
SELECT 'ing' AS query, (place - 1) // 100 AS page_no, to_json({{'query': 'ing', 'results':
  list({{'url': url, 'score': score, 'frequency': frequency, 'depth': depth}} ORDER BY place)}})::VARCHAR AS response
FROM numbered GROUP BY page_no"""

# --- robots ---------------------------------------------------------------------------------

_ROBOTS_HOSTS = """hosts AS (
  SELECT host_key, length(host_key) % 3 AS form, length(host_key) % 7 <> 0 AS served FROM (SELECT DISTINCT host_key FROM base)
),
forms(form, agent, ord, allow, path) AS (VALUES
  (0, 'latticebot', 1, false, '/fr/'), (0, 'latticebot', 2, true, '/fr/1'),
  (1, '*', 1, true, '/en/1'), (1, '*', 2, false, '/en'), (1, '*', 3, false, '/es/'), (1, '*', 4, false, '/%2A%3Fpage'),
  (2, '*', 1, true, ''), (2, '*', 2, false, '/de/')
),
rules AS (SELECT host_key, agent, ord::INTEGER AS ord, allow, path FROM hosts JOIN forms USING (form) WHERE served)"""

_ALLOWED = """allowed AS (
  SELECT url, coalesce(min_by(allow, ord), true) AS allowed FROM (
    SELECT b.url, r.allow, r.ord FROM {source} b LEFT JOIN rules r
    ON regexp_extract(b.url, '^([a-z]+://[^/?#]*)', 1) = r.host_key
       AND starts_with(regexp_replace(b.url, '^[a-z]+://[^/?#]*', ''), r.path)
  ) GROUP BY url
)"""

# --- graph ----------------------------------------------------------------------------------

_EDGES = """edges AS (
  SELECT 'n:' || c_nationkey AS src, 'c:' || c_custkey AS dst FROM customer
  UNION SELECT 'c:' || o_custkey, 'o:' || o_orderkey FROM orders
  UNION SELECT 'o:' || l_orderkey, 'p:' || l_partkey FROM lineitem
  UNION SELECT 'p:' || l_partkey, 's:' || l_suppkey FROM lineitem
  UNION SELECT 's:' || s_suppkey, 'n:' || s_nationkey FROM supplier
)"""


def _reach(name: str, seeds: str, depth: int, closed: str = "") -> str:
    """Every (url, seed, depth) a walk of at most ``depth`` steps finds outside the closed set."""
    keep = f" AND e.dst NOT IN (SELECT url FROM {closed})" if closed else ""
    return f"""{name}_walk(url, seed, depth) AS (
  SELECT * FROM (VALUES {seeds}) s(url, seed, depth)
  UNION SELECT e.dst, w.seed, w.depth + 1 FROM {name}_walk w JOIN edges e ON e.src = w.url WHERE w.depth < {depth}{keep}
), {name} AS (
  SELECT url, 'n:' || min_by(seed, depth * 100 + seed) AS origin_url, min(depth)::INTEGER AS depth FROM {name}_walk GROUP BY url
)"""


_SEEDS_3 = "('n:0', 0, 0), ('n:3', 3, 0), ('n:7', 7, 0)"
_BFS_1 = f"WITH RECURSIVE {_EDGES}, {_reach('run', chr(40) + chr(39) + 'n:0' + chr(39) + ', 0, 0)', 10)}"
_BFS_3 = f"WITH RECURSIVE {_EDGES}, {_reach('run', _SEEDS_3, 10)} SELECT url, origin_url, depth FROM run"
_BFS_TURN = f"""WITH RECURSIVE {_EDGES}, {_reach('one', "('n:0', 0, 0)", 3)}, {_reach('two', "('n:7', 7, 0)", 3, 'one')}
SELECT url, origin_url, depth FROM one UNION ALL SELECT url, origin_url, depth FROM two WHERE url NOT IN (SELECT url FROM one)"""

# --- crawl over linked pages ----------------------------------------------------------------

_CRAWL = f"""WITH RECURSIVE sized AS (SELECT *, (SELECT (ceil(count(*) / 60) * 10)::BIGINT FROM pages) AS stride FROM pages),
linked AS (
  SELECT p.page_id, p.url, p.stride, p.html || coalesce('<p><a href="' || n.url || '">next</a></p>', '') AS html
  FROM sized p LEFT JOIN sized n ON n.page_id = p.page_id + p.stride
),
{_base('linked')}, {_OUTCOMES}, {_ROBOTS_HOSTS}, {_ALLOWED.format(source='base')},
links AS (
  SELECT DISTINCT url AS src, regexp_replace(CASE WHEN starts_with(href, '/') THEN host_key || href ELSE href END, '#.*$', '') AS dst
  FROM (SELECT r.url, host_key, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href
        FROM rows r JOIN allowed a USING (url) WHERE a.allowed AND kind < 7)
),
walk(url, seed, depth) AS (
  SELECT b.url, b.page_id, 0 FROM base b WHERE page_id < (SELECT max(stride) FROM sized)
  UNION SELECT l.dst, w.seed, w.depth + 1 FROM walk w JOIN links l ON l.src = w.url WHERE w.depth < 6
),
visited AS (
  SELECT w.url, b.url AS origin_url, w.depth::INTEGER AS depth
  FROM (SELECT url, min_by(seed, depth::BIGINT * 1000000000 + seed) AS seed, min(depth) AS depth FROM walk GROUP BY url) w
  JOIN base b ON b.page_id = w.seed
),
rule_check AS (SELECT v.*, a.allowed FROM visited v JOIN ({_ALLOWED.format(source='visited').replace('allowed AS (', '(', 1).strip()[1:-1]}) a USING (url)),
stored AS (
  SELECT v.url, v.origin_url, v.depth, coalesce(r.shown_title, '') AS title, coalesce(r.status_code, 0)::INTEGER AS status_code,
         coalesce(r.outcome, 'error') AS outcome, CASE WHEN r.url IS NULL THEN 'no response' ELSE r.error END AS error,
         coalesce(r.content, '') AS content
  FROM rule_check v LEFT JOIN rows r USING (url) WHERE v.allowed
)"""

# The same with the whole text of pages that are not HTML.
_WHOLE_CRAWL = _CRAWL.replace("left(html, 1000)", "html")


# --- full text ------------------------------------------------------------------------------

_PAGE_CORPUS = f"WITH {_base()}, corpus AS (SELECT url, origin_url, depth, title, visible AS content FROM base)"
_REPLACED_CORPUS = f"""WITH {_base()}, {_OUTCOMES},
corpus AS (SELECT url, origin_url, depth, shown_title AS title, content FROM rows)"""

_TOKENS = rf"""tokens AS (
  SELECT url, field, unnest(generate_series(0, len(terms) - 1)) AS pos, unnest(terms) AS term FROM (
    SELECT url, 'title' AS field, regexp_extract_all({_fold('title')}, '[\p{{L}}\p{{N}}\p{{Co}}]+') AS terms FROM corpus
    UNION ALL
    SELECT url, 'content', regexp_extract_all({_fold('content')}, '[\p{{L}}\p{{N}}\p{{Co}}]+') FROM corpus
  ) WHERE len(terms) > 0
),
docs AS (
  SELECT c.url, c.origin_url, c.depth, coalesce(t.n, 0) AS n_tokens
  FROM corpus c LEFT JOIN (SELECT url, count(*) AS n FROM tokens GROUP BY url) t USING (url)
),
stats AS (SELECT count(*) AS n_docs, avg(n_tokens) AS avg_tokens FROM docs)"""


def _weight(f: str, n: str) -> str:
    idf = f"ln((n_docs - {n} + 0.5) / ({n} + 0.5))"
    return (
        f"(CASE WHEN {idf} <= 0 THEN 1e-6 ELSE {idf} END) * {f} * 2.2 / ({f} + 1.2 * (0.25 + 0.75 * n_tokens / avg_tokens))"
    )


def _search(where: str, phrases: list[str], corpus: str = _PAGE_CORPUS, kept: list[str] | None = None, scored=None, limit=None, columns=None, extra="") -> str:
    """BM25 over phrases, each given as SQL for the url of every occurrence; ``kept`` are those NEAR keeps."""
    parts = [f"o{i} AS (SELECT url, count(*) AS f FROM ({sql}) GROUP BY url)" for i, sql in enumerate(phrases)]
    parts += [f"k{i} AS (SELECT url, count(*) AS f FROM ({sql}) GROUP BY url)" for i, sql in enumerate(kept or phrases)]
    numbers = range(len(phrases))
    parts.append(
        "counts AS (SELECT d.*, " + ", ".join(f"coalesce(k{i}.f, 0) AS f{i}" for i in numbers) + " FROM docs d "
        + " ".join(f"LEFT JOIN k{i} ON k{i}.url = d.url" for i in numbers) + ")"
    )
    rank = " + ".join(_weight(f"f{i}", f"(SELECT count(*) FROM o{i})") for i in (scored or numbers))
    best = f" ORDER BY rank, url LIMIT {limit}" if limit else ""
    picked = columns or "url, origin_url, depth, round(rank, 6) AS rank"
    return (
        f"{corpus}, {_TOKENS}{extra}, {', '.join(parts)}\nSELECT {picked} FROM (\n"
        f"SELECT url, origin_url, depth, -({rank}) AS rank FROM counts, stats WHERE {where}){best}"
    )


def _term(term: str, extra: str = "") -> str:
    return f"SELECT url FROM tokens WHERE term = '{term}'{extra}"


_PHRASE = (
    "SELECT a.url FROM tokens a JOIN tokens b ON a.url = b.url AND a.field = b.field AND b.pos = a.pos + 1 "
    "WHERE a.term = 'of' AND b.term = 'the'"
)


def _near(term: str, other: str, distance: int) -> str:
    return (
        f"SELECT url FROM tokens a WHERE term = '{term}' AND EXISTS (SELECT 1 FROM tokens b WHERE b.url = a.url "
        f"AND b.field = a.field AND b.term = '{other}' AND abs(b.pos - a.pos) <= {distance + 1})"
    )


def _cut(suffixes) -> str:
    return f"regexp_extract(w, '^(.+?)({'|'.join(suffixes)})$', {{}})"


# Suffix tables of Porter's paper, each replaced after a measure above 0 (steps 2 and 3) or cut after one above 1 (step 4).
_STEP_2 = dict(pair.split(":") for pair in (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize ation:ate "
    "ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
).split())
_STEP_3 = dict(pair.split(":") for pair in "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:".split())
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _stems() -> str:
    """Porter's steps as nested selects over the distinct terms."""
    # A run of consonants (y is one at the start) and a run of vowels (y is one after a consonant).
    c, v = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    start = f"({c}{v}|[aeiou]+)"
    over_0, is_1, over_1 = f"^{start}{c}", f"^{start}{c}({v})?$", f"^{start}{c}{v}{c}"
    vowel, cvc = f"^{start}", "([^aeiouy]|^y|[aeiou]y)[aeiouy][bcdfghjklmnpqrstvz0-9]$"

    def table(pairs: dict[str, str]) -> tuple[str, str]:
        cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in pairs.items())
        return _cut(pairs), f"CASE WHEN x <> '' AND regexp_matches(s, '{over_0}') THEN s || CASE x {cases} END ELSE w END"

    steps = [
        (_cut(["s"]), "CASE WHEN regexp_matches(w, '^.+(sses|ies)$') THEN left(w, length(w) - 2) "
                      "WHEN regexp_matches(w, '[^s]s$') THEN left(w, length(w) - 1) ELSE w END"),
        (_cut(["eed", "ed", "ing"]),
         f"CASE WHEN x = 'eed' THEN CASE WHEN regexp_matches(s, '{over_0}') THEN s || 'ee' ELSE w END "
         f"WHEN x <> '' AND regexp_matches(s, '{vowel}') THEN s || '|' ELSE w END"),
        (_cut(["[|]"]),
         "CASE WHEN x = '' THEN w WHEN regexp_matches(s, '^.+(at|bl|iz)$') THEN s || 'e' "
         "WHEN length(s) > 1 AND s[-1] = s[-2] AND regexp_matches(s, '[b-df-hj-km-np-rtv-y0-9]$') THEN left(s, length(s) - 1) "
         f"WHEN regexp_matches(s, '{is_1}') AND regexp_matches(s, '{cvc}') THEN s || 'e' ELSE s END"),
        (_cut(["y"]), f"CASE WHEN x <> '' AND regexp_matches(s, '{vowel}') THEN s || 'i' ELSE w END"),
        table(_STEP_2),
        table(_STEP_3),
        (_cut(_STEP_4),
         f"CASE WHEN x <> '' AND regexp_matches(s, '{over_1}') AND (x <> 'ion' OR regexp_matches(s, '[st]$')) THEN s ELSE w END"),
        (_cut(["e"]),
         f"CASE WHEN x <> '' AND (regexp_matches(s, '{over_1}') OR regexp_matches(s, '{is_1}') AND NOT regexp_matches(s, '{cvc}')) "
         "THEN s ELSE w END"),
        (_cut(["l"]), f"CASE WHEN ends_with(w, 'll') AND regexp_matches(s, '{over_1}') THEN s ELSE w END"),
    ]
    sql = "SELECT DISTINCT term, term AS w FROM tokens WHERE strlen(term) BETWEEN 3 AND 64"
    for cut, result in steps:
        sql = f"SELECT term, {result} AS w FROM (SELECT *, {cut.format(1)} AS s, {cut.format(2)} AS x FROM ({sql}))"
    return f"""stems AS (
  SELECT term, w AS stem FROM ({sql})
  UNION ALL SELECT DISTINCT term, term FROM tokens WHERE strlen(term) NOT BETWEEN 3 AND 64
)"""


_DOC_CORPUS = f"WITH {_DOCUMENTS.replace('docs AS', 'doc_rows AS')}, corpus AS (SELECT url, origin_url, depth, title, visible AS content FROM doc_rows)"

_TEXT_BATCH = rf"""{_DOC_CORPUS}, {_TOKENS},
asked AS (
  SELECT query_id, term, count(*) AS weight FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all({_fold('text')}, '[\p{{L}}\p{{N}}\p{{Co}}]+')) AS term FROM benchmark
  ) GROUP BY ALL
),
hits AS (SELECT url, term, count(*) AS f FROM tokens WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
seen AS (SELECT term, count(*) AS n FROM hits GROUP BY term),
scores AS (
  SELECT query_id, url, -sum(round(({_weight('f', 'n')}) * 1e12)::BIGINT * weight) / 1e12 AS rank
  FROM hits JOIN seen USING (term) JOIN asked USING (term) JOIN docs USING (url), stats GROUP BY ALL
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, url)::INTEGER AS position FROM scores)
SELECT query_id, position, url, origin_url, depth, round(rank, 6) AS rank FROM ranked JOIN docs USING (url) WHERE position <= 25"""


def oracle_sql() -> dict[str, str]:
    page_words = f"{_PAGE_POSTINGS} {_ALL_COLUMNS}"
    outcome_words = f"{_OUTCOME_POSTINGS} {_ALL_COLUMNS}"
    from_pages = f"WITH {_base()}, {_OUTCOMES}"
    resumed = _BFS_3
    return {
        "word_search_relevance": _word_search(_PAGE_POSTINGS, "ing"),
        "word_search_frequency": _word_search(_PAGE_POSTINGS, "la"),
        "word_search_depth": _word_search(_PAGE_POSTINGS, "und"),
        "word_search_documents": _word_search(_DOC_POSTINGS, "ing"),
        "page_word_postings": page_words,
        "document_word_postings": f"{_DOC_POSTINGS} {_ALL_COLUMNS}",
        "word_doc_frequency": f"{_DOC_POSTINGS} SELECT word, count(DISTINCT url) AS n_urls FROM postings GROUP BY word HAVING count(DISTINCT url) > 1",
        "posting_text_roundtrip": page_words,
        "posting_append": (
            f"WITH {_base()}, {_OUTCOMES}, {_postings('content', '(FROM rows WHERE error IS NULL)', 'first')}, "
            f"{_postings('visible', 'base', 'second')} FROM first UNION ALL FROM second"
        ),
        "word_search_batch": _BATCH,
        "score_audit": _AUDIT,
        "search_json": _JSON,
        "page_titles": f"WITH {_base()} SELECT url, title, {_n_tokens('visible')} AS n_tokens FROM base",
        "links_of_pages": f"WITH {_base()}, {_LINKS} SELECT src, pos, dst FROM links",
        "link_hosts": f"WITH {_base()}, {_LINKS} SELECT DISTINCT regexp_extract(dst, '^([a-z]+://[^/?#]*)', 1) AS host_key FROM links",
        "page_outcomes": (
            f"{from_pages} SELECT url, status_code, outcome, error, shown_title AS title, {_n_tokens('content')} AS n_tokens, "
            "(CASE WHEN kind >= 7 THEN 0 ELSE len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) END)::INTEGER AS n_links FROM rows"
        ),
        "page_errors": f"{from_pages} SELECT url, depth, status_code, error FROM rows WHERE error IS NOT NULL",
        "nonhtml_excerpts": f"{from_pages} SELECT url, '' AS title, left(html, 1000) AS content, 0 AS n_links FROM rows WHERE kind = 8",
        "page_charsets": r"""SELECT page_id, (CASE WHEN page_id % 6 = 5 THEN 0 ELSE 200 END)::INTEGER AS status_code,
  CASE WHEN page_id % 6 = 5 THEN 'unknown encoding: no-such' END AS error, length(body)::INTEGER AS n_chars, md5(body) AS digest
FROM (SELECT page_id, CASE page_id % 6 WHEN 5 THEN '' WHEN 1 THEN html || chr(65533)
      WHEN 2 THEN regexp_replace(html, '[^\x00-\x7F\x{A0}-\x{FF}]', '?', 'g')
      WHEN 3 THEN regexp_replace(html, '[^\x00-\x7F\x{A0}-\x{FF}]', '?', 'g') ELSE html END AS body FROM pages)""",
        "robots_rule_table": f"WITH {_base()}, {_ROBOTS_HOSTS} SELECT host_key, agent, ord, allow, path FROM rules",
        "robots_filter": f"WITH {_base()}, {_ROBOTS_HOSTS}, {_ALLOWED.format(source='base')} SELECT url FROM base JOIN allowed USING (url) WHERE allowed",
        "seed_list": f"WITH {_base()} SELECT url, url AS origin_url, 0 AS depth, min(page_id)::BIGINT AS seed_ord FROM base GROUP BY url",
        "new_page_urls": f"""WITH {_base()}, {_LINKS}, ranked AS (
  SELECT dst AS url, origin_url, depth + 1 AS depth, row_number() OVER (PARTITION BY dst ORDER BY depth, origin_url) AS n FROM links)
SELECT url, origin_url, depth FROM ranked WHERE n = 1 AND url NOT IN (SELECT url FROM base)""",
        "visited_set": f"""WITH {_base()}, {_LINKS}, ranked AS (
  SELECT dst AS url, origin_url, depth + 1 AS depth, row_number() OVER (PARTITION BY dst ORDER BY depth, origin_url) AS n FROM links)
SELECT url, origin_url, depth FROM ranked WHERE n = 1 AND url NOT IN (SELECT url FROM base)
UNION ALL SELECT url, origin_url, depth FROM base""",
        "page_upsert": f"""{from_pages} SELECT url, origin_url, depth,
  CASE WHEN depth = 0 THEN title ELSE shown_title END AS title,
  (CASE WHEN depth = 0 THEN 200 ELSE status_code END)::INTEGER AS status_code,
  CASE WHEN depth = 0 THEN NULL ELSE error END AS error,
  CASE WHEN depth = 0 THEN '2024-01-10' ELSE '2024-01-11' END AS fetched_day,
  CASE WHEN depth = 0 THEN {_n_tokens('visible')} ELSE {_n_tokens('content')} END AS n_tokens FROM rows""",
        "fts_row_replace": _search("f0 > 0", [_term("ing")], corpus=_REPLACED_CORPUS),
        "bounded_bfs": f"{_BFS_1} SELECT url, origin_url, depth FROM run",
        "bfs_many_seeds": _BFS_3,
        "bfs_incremental": _BFS_TURN,
        "bfs_resume": resumed,
        "bfs_pending": f"{_BFS_1} SELECT url, origin_url, depth FROM run WHERE depth = 3",
        "crawl_job": f"{_CRAWL} SELECT url, origin_url, depth, title, status_code, outcome, error, {_n_tokens('content')} AS n_tokens FROM stored",
        "crawl_two_runs": f"{_CRAWL} SELECT url, origin_url, depth, title, status_code, error, {_n_tokens('content')} AS n_tokens FROM stored",
        "crawl_postings": f"{_WHOLE_CRAWL}, {_postings('content', '(FROM stored WHERE error IS NULL)')} {_ALL_COLUMNS}",
        "crawl_stores_opened": f"{_CRAWL}, {_postings('content', '(FROM stored WHERE error IS NULL AND depth < 2)')} {_ALL_COLUMNS}",
        "crawl_report": f"""{_CRAWL}, per_depth AS (
  SELECT depth, sum(c)::BIGINT AS crawled_pages, sum(e)::BIGINT AS error_pages, sum(d)::BIGINT AS discovered_urls FROM (
    SELECT depth, (error IS NULL)::INTEGER AS c, (error IS NOT NULL)::INTEGER AS e, 0 AS d FROM stored
    UNION ALL SELECT depth, 0, 0, 1 FROM visited) GROUP BY depth)
SELECT depth, crawled_pages, error_pages, discovered_urls FROM per_depth
UNION ALL SELECT NULL, sum(crawled_pages)::BIGINT, sum(error_pages)::BIGINT, sum(discovered_urls)::BIGINT FROM per_depth""",
        "crawl_store_report": f"""{_CRAWL} SELECT count(*) AS crawled, count(error) AS errors,
  (SELECT count(*) FROM visited) AS discovered FROM stored""",
        "crawl_frontier_size": f"WITH {_base()}, {_LINKS} SELECT count(DISTINCT dst) AS frontier_size FROM links WHERE dst NOT IN (SELECT url FROM base)",
        "fts_term": _search("f0 > 0", [_term("ing")]),
        "fts_top25": _search("f0 > 0", [_term("une")], limit=25),
        "fts_results": _search("f0 > 0", [_term("ube")], limit=25, columns="url, origin_url, depth"),
        "fts_and": _search("f0 > 0 AND f1 > 0", [_term("ing"), _term("ea")]),
        "fts_or": _search("f0 > 0 OR f1 > 0 OR f2 > 0", [_term("una"), _term("ea"), _term("sch")]),
        "fts_not": _search("f0 > 0 AND f1 = 0", [_term("the"), _term("ing")], scored=[0]),
        "fts_phrase": _search("f0 > 0", [_PHRASE]),
        "fts_prefix": _search("f0 > 0", ["SELECT url FROM tokens WHERE starts_with(term, 'erth')"]),
        "fts_column": _search("f0 > 0", [_term("the", " AND field = 'title'")]),
        "fts_near": _search(
            "f0 > 0 AND f1 > 0", [_term("er"), _term("ti")], kept=[_near("er", "ti", 6), _near("ti", "er", 6)]
        ),
        "fts_initial": _search("f0 > 0", [_term("the", " AND pos = 0")]),
        "fts_batch_topk": _TEXT_BATCH,
        "fts_document_frequency": f"{_DOC_CORPUS}, {_TOKENS} SELECT term, count(DISTINCT url) AS n_docs FROM tokens GROUP BY term",
        "fts_vocabulary": f"{_DOC_CORPUS}, {_TOKENS}, {_stems()} SELECT term, stem FROM stems",
        "fts_stemmed": _search(
            "f0 > 0 OR f1 > 0",
            [f"SELECT url FROM tokens JOIN stems USING (term) WHERE stem = '{stem}'" for stem in ("ing", "er")],
            extra=f", {_stems()}",
        ),
        "stream_word_index": outcome_words,
        "stream_page_upsert": f"""{from_pages} SELECT url, origin_url, depth, shown_title AS title, status_code::INTEGER AS status_code,
  error, {_n_tokens('content')} AS n_tokens FROM rows""",
        "stream_url_dedupe": f"WITH {_base()} SELECT DISTINCT origin_url AS url FROM base",
        "stream_urls_after_crawl": f"WITH {_base()} SELECT DISTINCT url FROM base WHERE url NOT IN (SELECT url FROM base WHERE page_id % 4 = 0)",
        "fts_stored_document_frequency": f"{_DOC_CORPUS}, {_TOKENS} SELECT term, count(DISTINCT url) AS n_docs FROM tokens GROUP BY term",
        "stream_counters": f"{from_pages} SELECT outcome, count(*) AS pages FROM rows GROUP BY outcome",
        "stream_search_snapshot": _word_search(_OUTCOME_POSTINGS, "ing"),
        "stream_restart": outcome_words,
        "stream_text_index": f"{_REPLACED_CORPUS}, {_TOKENS} SELECT term, count(DISTINCT url) AS n_docs FROM tokens GROUP BY term",
        "stream_text_search": _search("f0 > 0", [_term("ing")], corpus=_REPLACED_CORPUS),
    }
