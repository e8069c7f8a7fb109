"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weblattice import schemas
from weblattice.functions.text import text_tokens
from weblattice.functions.words import index_words
from weblattice.functions.content import is_html
from weblattice.operators.extraction import extract_pages, page_links, with_outcome
from weblattice.operators.postings import append_postings, word_postings, words_on_many_urls
from weblattice.operators.reports import distinct_hosts, error_pages, frontier_size, store_report
from weblattice.operators.robots import robots_allowed, robots_rules
from weblattice.operators.text_index import TextIndex, add_to_text_index, build_text_index, document_frequency, load_text_index, save_text_index
from weblattice.operators.text_search import all_of, any_of, but_not, near, phrase, search_text, search_text_batch
from weblattice.operators.visited import add_visited, new_urls, upsert_pages
from weblattice.operators.word_search import audit_scores, search_words, search_words_batch
from weblattice.plans import corpus
from weblattice.plans.crawl import Crawl, crawl, crawl_into, extraction, open_stores
from weblattice.plans.traversal import store_edges, traverse, traverse_in_turn
from weblattice.runtime import materialize, new_folder
from weblattice.sources.frontier import load_frontier, save_frontier
from weblattice.sources.responses import decode_responses, seed_tasks, stream_responses
from weblattice.sources.results import search_response, text_results
from weblattice.sources.visited_store import VisitedStore
from weblattice.sources.word_store import append_posting_lines, read_posting_lines, read_postings, write_postings
from weblattice.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

WORD = "ing"
CRAWL_DEPTH = 6
GRAPH_DEPTH = 10


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _n_tokens() -> Column:
    return F.size(text_tokens(F.col("content"))).alias("n_tokens")


# --- word index and word search -------------------------------------------------------------


def _stored(postings: DataFrame) -> DataFrame:
    """The word index as stored, sorted by word: a search reads the row groups of its word."""
    path = new_folder(postings.sparkSession, "word-index")
    write_postings(postings, path)
    return read_postings(postings.sparkSession, path)


@query
def word_search_relevance(spark, sf_dir):
    return search_words(_stored(word_postings(corpus.good_pages(spark, sf_dir))), f" {WORD.upper()} ")


@query
def word_search_frequency(spark, sf_dir):
    return search_words(_stored(word_postings(corpus.good_pages(spark, sf_dir))), "la", "frequency")


@query
def word_search_depth(spark, sf_dir):
    return search_words(_stored(word_postings(corpus.good_pages(spark, sf_dir))), "und", "depth")


@query
def word_search_documents(spark, sf_dir):
    return search_words(_stored(word_postings(corpus.text_documents(spark, sf_dir))), WORD)


@query
def page_word_postings(spark, sf_dir):
    return word_postings(corpus.good_pages(spark, sf_dir))


@query
def document_word_postings(spark, sf_dir):
    return word_postings(corpus.text_documents(spark, sf_dir))


@query
def word_doc_frequency(spark, sf_dir):
    return words_on_many_urls(word_postings(corpus.text_documents(spark, sf_dir)))


@query
def posting_text_roundtrip(spark, sf_dir):
    path = new_folder(spark, "posting-lines")
    append_posting_lines(word_postings(corpus.good_pages(spark, sf_dir)), path)
    return read_posting_lines(spark, path)


@query
def posting_append(spark, sf_dir):
    """A crawl and a later crawl of the same pages into one store: all postings stay."""
    first = word_postings(with_outcome(extract_pages(corpus.responses(spark, sf_dir))))
    second = word_postings(corpus.good_pages(spark, sf_dir))
    return append_postings(first, second)


def _benchmark_words(spark, sf_dir) -> DataFrame:
    words = corpus.table(spark, sf_dir, "benchmark").select(F.explode(index_words(F.col("text"))).alias("query_id")).distinct()
    return words.select("query_id", F.concat(F.lit("  "), F.upper("query_id"), F.lit("\t")).alias("query"))


@query
def word_search_batch(spark, sf_dir):
    postings = _stored(word_postings(corpus.text_documents(spark, sf_dir)))
    found = search_words_batch(postings, _benchmark_words(spark, sf_dir))
    return found.drop("query")


@query
def score_audit(spark, sf_dir):
    postings = materialize(word_postings(corpus.good_pages(spark, sf_dir)), new_folder(spark, "postings"))
    words = materialize(words_on_many_urls(postings).select("word"), new_folder(spark, "words"))
    queries = words.select(F.col("word").alias("query_id"), F.col("word").alias("query"))
    results = search_words_batch(postings, queries, limit=3).withColumnRenamed("query_id", "word")
    return audit_scores(postings, results, words=words)


@query
def search_json(spark, sf_dir):
    return search_response(search_words(_stored(word_postings(corpus.good_pages(spark, sf_dir))), WORD), WORD)


# --- pages, links, robots -------------------------------------------------------------------


@query
def page_titles(spark, sf_dir):
    return corpus.good_pages(spark, sf_dir).select("url", "title", _n_tokens())


@query
def links_of_pages(spark, sf_dir):
    return page_links(corpus.good_pages(spark, sf_dir))


@query
def link_hosts(spark, sf_dir):
    return distinct_hosts(page_links(corpus.good_pages(spark, sf_dir)), "dst")


@query
def page_outcomes(spark, sf_dir):
    pages = with_outcome(extract_pages(corpus.responses(spark, sf_dir)))
    return pages.select("url", "status_code", "outcome", "error", "title", _n_tokens(), F.size("links").alias("n_links"))


@query
def page_errors(spark, sf_dir):
    return error_pages(with_outcome(corpus.responses(spark, sf_dir))).select("url", "depth", "status_code", "error")


@query
def nonhtml_excerpts(spark, sf_dir):
    plain = corpus.responses(spark, sf_dir).filter(~is_html(F.col("content_type")) & F.col("error").isNull())
    return extract_pages(plain).select("url", "title", "content", F.size("links").alias("n_links"))


@query
def page_charsets(spark, sf_dir):
    """Bodies in five encodings and under an unknown label, decoded again."""
    kind = F.col("page_id") % 6
    narrow = F.regexp_replace("html", r"[^\x00-\x7F\xA0-\xFF]", "?")
    label = (
        F.when(kind == 0, "text/html").when(kind == 1, "text/html; charset=UTF-8")
        .when(kind == 2, "text/html;charset=\"ISO-8859-1\"").when(kind == 3, "text/html; charset=windows-1252")
        .when(kind == 4, "text/html; charset=utf-16").otherwise("text/html; charset=no-such")
    )
    body = (
        F.when(kind.isin(2, 3), F.encode(narrow, "ISO-8859-1")).when(kind == 4, F.encode("html", "UTF-16"))
        .when(kind == 1, F.concat(F.encode("html", "UTF-8"), F.lit(b"\xff")))
        .otherwise(F.encode("html", "UTF-8"))
    )
    raw = corpus.spread(corpus.table(spark, sf_dir, "pages")).select(
        "page_id", F.lit("u").alias("url"), F.lit(200).alias("status_code"), label.alias("content_type"),
        body.alias("body"), F.lit(None).cast("string").alias("error"),
    )
    return decode_responses(raw).select(
        "page_id", "status_code", "error", F.length("body").alias("n_chars"), F.md5("body").alias("digest")
    )


@query
def robots_rule_table(spark, sf_dir):
    pages = corpus.responses(spark, sf_dir)
    return robots_rules(corpus.robots_files(pages))


@query
def robots_filter(spark, sf_dir):
    pages = corpus.responses(spark, sf_dir).select("url")
    return robots_allowed(pages, robots_rules(corpus.robots_files(pages)))


# --- url sets and page store ----------------------------------------------------------------


@query
def seed_list(spark, sf_dir):
    return seed_tasks(corpus.page_seeds(spark, sf_dir), 0)


def _discovered(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("links").alias("url"), "origin_url", (F.col("depth") + 1).alias("depth"))


@query
def new_page_urls(spark, sf_dir):
    pages = corpus.good_pages(spark, sf_dir)
    return new_urls(_discovered(pages), corpus.responses(spark, sf_dir))


@query
def visited_set(spark, sf_dir):
    pages = corpus.good_pages(spark, sf_dir)
    visited = corpus.responses(spark, sf_dir).select("url", "origin_url", "depth", F.lit("2024-01-01").cast("timestamp").alias("discovered_at"))
    return add_visited(visited, new_urls(_discovered(pages), visited)).drop("discovered_at")


def _fetch_time(days) -> Column:
    return F.timestamp_add("DAY", days, F.lit("2024-01-10").cast("timestamp")).alias("fetched_at")


def _store_rows(responses: DataFrame, days) -> DataFrame:
    pages = with_outcome(extract_pages(responses))
    return pages.select("url", "origin_url", "depth", "title", "content", "status_code", "error", _fetch_time(days))


@query
def page_upsert(spark, sf_dir):
    """A store of good fetches, then fetches with errors, of which those of depth 0 are older."""
    raw = corpus.spread(corpus.table(spark, sf_dir, "pages"))
    store = _store_rows(corpus.as_good_pages(raw), F.lit(0))
    fetched = _store_rows(corpus.as_responses(raw), F.when(F.col("depth") == 0, -1).otherwise(1))
    day = F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_day")
    return upsert_pages(store, fetched).select("url", "origin_url", "depth", "title", "status_code", "error", day, _n_tokens())


@query
def fts_row_replace(spark, sf_dir):
    """Good fetches indexed, then fetches with errors and of plain text added as a second segment."""
    pages = with_outcome(extract_pages(corpus.responses(spark, sf_dir)))
    replaced = pages.filter(F.col("error").isNotNull() | ~is_html(F.col("content_type")))
    root = new_folder(spark, "text-index")
    save_text_index(_page_index(spark, sf_dir), root)
    return _ranked(search_text(add_to_text_index(spark, root, replaced, stem=False), WORD, limit=None))


# --- traversal and crawl --------------------------------------------------------------------


@query
def bounded_bfs(spark, sf_dir):
    return traverse(corpus.key_graph(spark, sf_dir), GRAPH_DEPTH, corpus.graph_seeds(spark, sf_dir, 0)).visited


@query
def bfs_many_seeds(spark, sf_dir):
    return traverse(corpus.key_graph(spark, sf_dir), GRAPH_DEPTH, corpus.graph_seeds(spark, sf_dir, 3, 0, 7)).visited


@query
def bfs_incremental(spark, sf_dir):
    seeds = [corpus.graph_seeds(spark, sf_dir, 0), corpus.graph_seeds(spark, sf_dir, 7)]
    return traverse_in_turn(corpus.key_graph(spark, sf_dir), 3, seeds).visited


@query
def bfs_resume(spark, sf_dir):
    """Stop after three levels, save the frontier, load it and go on: the same as one run."""
    edges = store_edges(corpus.key_graph(spark, sf_dir))
    first = traverse(edges, GRAPH_DEPTH, corpus.graph_seeds(spark, sf_dir, 3, 0, 7), levels=3)
    root = new_folder(spark, "frontier")
    save_frontier(first.frontier, root)
    rest = traverse(edges, GRAPH_DEPTH, visited=first.visited, frontier=load_frontier(spark, root))
    edges.drop()
    return first.visited.unionByName(rest.visited)


@query
def bfs_pending(spark, sf_dir):
    """The frontier that a run stopped after three levels leaves."""
    run = traverse(corpus.key_graph(spark, sf_dir), GRAPH_DEPTH, corpus.graph_seeds(spark, sf_dir, 0), levels=3)
    root = new_folder(spark, "frontier")
    save_frontier(run.frontier, root)
    return load_frontier(spark, root).select("url", "origin_url", "depth")


def _crawl(spark, sf_dir, whole_text: bool = False) -> Crawl:
    responses = corpus.linked_responses(spark, sf_dir)
    parsed = extraction(responses, whole_text=whole_text)
    return crawl(parsed, corpus.chain_seeds(spark, sf_dir), CRAWL_DEPTH, corpus.robots_files(responses), extracted=True)


@query
def crawl_job(spark, sf_dir):
    pages = _crawl(spark, sf_dir).pages
    return pages.select("url", "origin_url", "depth", "title", "status_code", "outcome", "error", _n_tokens())


@query
def crawl_postings(spark, sf_dir):
    """Words of the whole text of each page, plain text included."""
    return _crawl(spark, sf_dir, whole_text=True).postings


@query
def crawl_report(spark, sf_dir):
    return _crawl(spark, sf_dir).counters


@query
def crawl_store_report(spark, sf_dir):
    run = _crawl(spark, sf_dir)
    return store_report(run.pages, run.visited)


@query
def crawl_two_runs(spark, sf_dir):
    """A crawl stopped after two levels, resumed from its stores, and run once more, which finds nothing to do: the page store."""
    responses, root = corpus.linked_responses(spark, sf_dir), new_folder(spark, "crawl-stores")
    robots, seeds, parsed = corpus.robots_files(responses), corpus.chain_seeds(spark, sf_dir), extraction(responses)
    for levels in (2, None, None):
        crawl_into(root, parsed, seeds, CRAWL_DEPTH, robots, levels=levels, stem=False)
    store = jobs.read_page_store(spark, f"{root}/pages")
    return store.select("url", "origin_url", "depth", "title", "status_code", "error", _n_tokens())


@query
def crawl_stores_opened(spark, sf_dir):
    """Stores opened after two levels of a crawl, read while the crawl has gone on: postings of the pages of the same run."""
    responses, root = corpus.linked_responses(spark, sf_dir), new_folder(spark, "crawl-stores")
    robots, seeds, parsed = corpus.robots_files(responses), corpus.chain_seeds(spark, sf_dir), extraction(responses)
    crawl_into(root, parsed, seeds, CRAWL_DEPTH, robots, levels=2, stem=False)
    stores = open_stores(spark, root)
    crawl_into(root, parsed, seeds, CRAWL_DEPTH, robots, stem=False)
    return stores.words().join(stores.pages().select("url"), "url", "left_semi")


@query
def crawl_frontier_size(spark, sf_dir):
    """Links of all pages against the captured urls: discovered, not fetched."""
    pages = corpus.good_pages(spark, sf_dir)
    discovered = _discovered(pages).select("url").distinct()
    return frontier_size(discovered, corpus.responses(spark, sf_dir))


# --- full text ------------------------------------------------------------------------------


def _page_index(spark, sf_dir, stem: bool = False) -> TextIndex:
    return build_text_index(corpus.stored_pages(spark, sf_dir), stem)


def _saved(index: TextIndex) -> TextIndex:
    """The index as stored, sorted by term: a search reads the row groups of its terms, and the corpus size as written."""
    spark = index.documents.sparkSession
    return save_text_index(index, new_folder(spark, "text-index"))


def _ranked(results: DataFrame) -> DataFrame:
    return results.withColumn("rank", F.round("rank", 6))


def _page_search(spark, sf_dir, what, limit=None) -> DataFrame:
    return _ranked(search_text(_saved(_page_index(spark, sf_dir)), what, limit))


@query
def fts_term(spark, sf_dir):
    return _page_search(spark, sf_dir, WORD)


@query
def fts_top25(spark, sf_dir):
    return _page_search(spark, sf_dir, "une", limit=25)


@query
def fts_results(spark, sf_dir):
    return text_results(search_text(_saved(_page_index(spark, sf_dir)), "Übe"))


@query
def fts_and(spark, sf_dir):
    return _page_search(spark, sf_dir, all_of(WORD, "éa"))


@query
def fts_or(spark, sf_dir):
    return _page_search(spark, sf_dir, any_of("una", "éa", "sch"))


@query
def fts_not(spark, sf_dir):
    return _page_search(spark, sf_dir, but_not("the", WORD))


@query
def fts_phrase(spark, sf_dir):
    return _page_search(spark, sf_dir, "of the")


@query
def fts_prefix(spark, sf_dir):
    return _page_search(spark, sf_dir, phrase("erth", prefix=True))


@query
def fts_column(spark, sf_dir):
    return _page_search(spark, sf_dir, phrase("the", columns="title"))


@query
def fts_near(spark, sf_dir):
    return _page_search(spark, sf_dir, near("er", "ti", distance=6))


@query
def fts_initial(spark, sf_dir):
    return _page_search(spark, sf_dir, phrase("the", initial=True))


@query
def fts_batch_topk(spark, sf_dir):
    index = build_text_index(corpus.text_documents(spark, sf_dir), stem=False)
    queries = corpus.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return _ranked(search_text_batch(index, queries))


@query
def fts_document_frequency(spark, sf_dir):
    return document_frequency(build_text_index(corpus.text_documents(spark, sf_dir), stem=False))


@query
def fts_vocabulary(spark, sf_dir):
    return build_text_index(corpus.text_documents(spark, sf_dir)).vocabulary


@query
def fts_stemmed(spark, sf_dir):
    index = _saved(_page_index(spark, sf_dir, stem=True))
    return _ranked(search_text(index, any_of("ings", "ered"), limit=None))


# --- streams --------------------------------------------------------------------------------


BATCHES = 4


def _arriving(pages: DataFrame, name: str) -> str:
    """The pages in files, a ``BATCHES``-th of the rows in each."""
    folder = new_folder(pages.sparkSession, name)
    pages.write.partitionBy("arrival").parquet(folder)
    return folder


def _page_stream(spark, sf_dir, folder: str | None = None) -> DataFrame:
    """Responses that arrive in about ``BATCHES`` micro-batches."""
    folder = folder or _arriving(_page_files(spark, sf_dir), "arriving-pages")
    files = len(spark.read.parquet(folder).inputFiles())
    raw = stream_responses(
        spark, folder, "page_id bigint, url string, html string", maxFilesPerTrigger=str(-(-files // BATCHES)), recursiveFileLookup="true"
    )
    return corpus.as_responses(raw)


def _page_files(spark, sf_dir) -> DataFrame:
    return corpus.table(spark, sf_dir, "pages").select("page_id", "url", "html", (F.col("page_id") % BATCHES).alias("arrival"))


def _run(start, stream: DataFrame, name: str, **options) -> str:
    spark = stream.sparkSession
    root = new_folder(spark, name)
    start(stream, root, new_folder(spark, f"{name}-checkpoint"), **options).awaitTermination()
    return root


@query
def stream_word_index(spark, sf_dir):
    return jobs.read_word_index(spark, _run(jobs.stream_word_index, _page_stream(spark, sf_dir), "stream-words"))


@query
def stream_page_upsert(spark, sf_dir):
    stream = _page_stream(spark, sf_dir).withColumn("fetched_at", F.lit("2024-01-10").cast("timestamp"))
    store = jobs.read_page_store(spark, _run(jobs.stream_page_upsert, stream, "stream-pages"))
    return store.select("url", "origin_url", "depth", "title", "status_code", "error", _n_tokens())


@query
def stream_url_dedupe(spark, sf_dir):
    """Hosts of an arriving page stream, which all batches repeat, each passed on once."""
    urls = _page_stream(spark, sf_dir).select(F.col("origin_url").alias("url"))
    root = _run(jobs.stream_new_urls, urls, "stream-urls")
    return spark.read.schema("url string").parquet(root)


@query
def stream_urls_after_crawl(spark, sf_dir):
    """Pages that arrive after a crawl has stored its visited urls, which are those of the first batch: each url that it doesn't know, once."""
    pages = _page_files(spark, sf_dir)
    known = corpus.as_responses(pages.filter("arrival = 0")).select("url", "origin_url", F.lit(0).alias("depth"))
    seen = add_visited(spark.createDataFrame([], schemas.VISITED), new_urls(known, spark.createDataFrame([], "url string")))
    store = VisitedStore(spark, new_folder(spark, "visited"), ()).add(materialize(seen, new_folder(spark, "seen")), 0)
    return jobs.read_new_urls(spark, _run(jobs.stream_new_urls, _page_stream(spark, sf_dir).select("url"), "stream-urls", visited=store))


@query
def fts_stored_document_frequency(spark, sf_dir):
    """Document frequencies of a stored index of which a quarter of the documents is replaced: sums of what its segments have written down."""
    docs, root = corpus.text_documents(spark, sf_dir, spread_out=False), new_folder(spark, "text-index")
    save_text_index(build_text_index(docs, stem=False), root)
    index = add_to_text_index(spark, root, docs.filter("pmod(crc32(url), 4) = 0"), stem=False)
    return document_frequency(index)


@query
def stream_counters(spark, sf_dir):
    return jobs.read_counters(spark, _run(jobs.stream_counters, _page_stream(spark, sf_dir), "stream-counters"))


@query
def stream_search_snapshot(spark, sf_dir):
    """Word search on the committed batches of a stream, folded into one snapshot."""
    root = _run(jobs.stream_word_index, _page_stream(spark, sf_dir), "stream-words")
    jobs.compact_word_index(spark, root)
    return search_words(jobs.read_word_index(spark, root), WORD)


@query
def stream_restart(spark, sf_dir):
    """A stream over half of the pages ends; the other half arrives, and a second run from the same checkpoint goes on."""
    pages = _page_files(spark, sf_dir)
    folder = _arriving(pages.filter(F.col("arrival") < BATCHES // 2), "arriving-pages")
    root, checkpoint = new_folder(spark, "stream-words"), new_folder(spark, "stream-words-checkpoint")
    jobs.stream_word_index(_page_stream(spark, sf_dir, folder), root, checkpoint).awaitTermination()
    pages.filter(F.col("arrival") >= BATCHES // 2).write.mode("append").partitionBy("arrival").parquet(folder)
    jobs.stream_word_index(_page_stream(spark, sf_dir, folder), root, checkpoint).awaitTermination()
    return jobs.read_word_index(spark, root)


@query
def stream_text_index(spark, sf_dir):
    """Document frequencies of an index that grew by segments."""
    return document_frequency(load_text_index(spark, _run(
        jobs.stream_text_index, _page_stream(spark, sf_dir).withColumn("fetched_at", F.lit("2024-01-10").cast("timestamp")),
        "stream-text", stem=False,
    ), stem=False))


@query
def stream_text_search(spark, sf_dir):
    """Full-text search on the segments of a stream."""
    stream = _page_stream(spark, sf_dir).withColumn("fetched_at", F.lit("2024-01-10").cast("timestamp"))
    root = _run(jobs.stream_text_index, stream, "stream-text", stem=False)
    return _ranked(search_text(load_text_index(spark, root, stem=False), WORD, limit=None))
