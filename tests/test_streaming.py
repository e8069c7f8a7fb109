"""Streams give what the batch operators give, also across restarts and beside readers."""

from pyspark.sql import functions as F

from support import rows
from weblattice import schemas
from weblattice.operators.extraction import extract_pages, with_outcome
from weblattice.operators.postings import word_postings
from weblattice.operators.text_index import build_text_index, compact_text_index, live_runs, load_text_index
from weblattice.operators.text_search import any_of, search_text
from weblattice.operators.visited import add_visited, latest_pages, upsert_pages
from weblattice.operators.word_search import search_words
from weblattice.sources.responses import stream_responses
from weblattice.sources.visited_store import VisitedStore
from weblattice.streaming import jobs

SCHEMA = (
    "url string, origin_url string, depth int, status_code int, content_type string, body string, error string, fetched_at timestamp"
)


def arrive(spark, folder, start, stop, day):
    """One file of pages; every third url was there before, every fifth is an error."""
    frame = spark.range(start, stop).selectExpr(
        "concat('u', if(id % 3 = 0, 0, id)) AS url", "'o' AS origin_url", "cast(id % 4 AS int) AS depth",
        "if(id % 5 = 0, 0, 200) AS status_code", "'text/html' AS content_type",
        "concat('<p>python w', id % 7, ' w', id % 7, ' ', id) AS body", "if(id % 5 = 0, 'timed out', null) AS error",
        f"timestampadd(SECOND, cast(id AS int), timestamp'2024-01-{day:02}') AS fetched_at",
    )
    frame.coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return stream_responses(spark, folder, SCHEMA, maxFilesPerTrigger="1")


def batch(spark, folder):
    return spark.read.schema(SCHEMA).parquet(folder)


def test_word_index_equals_batch_and_survives_restart(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    counts = []
    for turn in range(2):
        arrive(spark, folder, turn * 10, turn * 10 + 10, 1)
        arrive(spark, folder, 100 + turn * 10, 108 + turn * 10, 2)
        jobs.stream_word_index(source(spark, folder), root, state).awaitTermination()
        found = jobs.read_word_index(spark, root)
        counts.append(search_words(found, "python").count())
        assert rows(found) == rows(word_postings(with_outcome(extract_pages(batch(spark, folder)))), *found.columns)
        if turn == 0:
            last = jobs.compact_word_index(spark, root)
            assert last == 1 and jobs.compact_word_index(spark, root) is None
            assert search_words(jobs.read_word_index(spark, root), "python").count() == counts[0]
    assert 0 < counts[0] < counts[1]
    jobs.stream_word_index(source(spark, folder), root, state).awaitTermination()  # nothing new
    assert search_words(jobs.read_word_index(spark, root), "python").count() == counts[1]


def test_reader_sees_only_finished_batches(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for start in (0, 20, 40):
        arrive(spark, folder, start, start + 12, 1)
    seen = []

    def probe(batch_frame, batch_id):
        word_postings(with_outcome(extract_pages(batch_frame))).write.parquet(f"{root}/batch={batch_id}")
        (tmp_path / "out" / f"batch={batch_id + 1}").mkdir()  # the next batch has begun to write
        seen.append(search_words(jobs.read_word_index(batch_frame.sparkSession, root), "python").count())
        (tmp_path / "out" / f"batch={batch_id + 1}").rmdir()

    query = source(spark, folder).writeStream.foreachBatch(probe).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(seen) == 3 and seen == sorted(seen) and seen[0] > 0


def test_page_upsert(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, folder, 0, 12, 3)
    arrive(spark, folder, 6, 20, 1)
    jobs.stream_page_upsert(source(spark, folder), root, state).awaitTermination()
    assert jobs.compact_page_store(spark, root) == 1  # after batches 0 and 1
    arrive(spark, folder, 9, 15, 5)
    arrive(spark, folder, 2, 8, 6)
    jobs.stream_page_upsert(source(spark, folder), root, state).awaitTermination()
    store = jobs.read_page_store(spark, root)
    pages = with_outcome(extract_pages(batch(spark, folder))).select(*store.columns)
    assert rows(store.fillna("-")) == rows(upsert_pages(pages.limit(0), pages).fillna("-"))
    assert store.count() == store.select("url").distinct().count()
    last = jobs.compact_page_store(spark, root)
    assert last == 3 and jobs.compact_page_store(spark, root) is None
    assert rows(jobs.read_page_store(spark, root).fillna("-")) == rows(store.fillna("-"))


def test_url_dedupe(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for start in (0, 5):
        arrive(spark, folder, start, start + 10, 1)
        urls = source(spark, folder).select("url")
        jobs.stream_new_urls(urls, root, state).awaitTermination()
    found = spark.read.schema("url string").parquet(root)
    assert rows(found) == rows(batch(spark, folder).select("url").distinct())


def test_url_dedupe_after_a_crawl(spark, tmp_path):
    """Nothing that the crawl knows is passed on, before and after a restart, and a batch opens no piece without a possible hit."""
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    found = spark.createDataFrame([(u, "o", 0) for u in ("u0", "u1", "u4", "u22", "x")], "url string, origin_url string, depth int")
    store = VisitedStore(spark, str(tmp_path / "visited"), ()).add(add_visited(spark.createDataFrame([], schemas.VISITED), found), 0)
    assert rows(jobs.read_new_urls(spark, root)) == []
    for start in (0, 5, 20):
        arrive(spark, folder, start, start + 10, 1)
        jobs.stream_new_urls(source(spark, folder).select("url"), root, state, visited=store).awaitTermination()
        want = sorted({r["url"] for r in batch(spark, folder).select("url").collect()} - {"u0", "u1", "u4", "u22", "x"})
        assert rows(jobs.read_new_urls(spark, root), "url") == [(u,) for u in want] and want
    later = VisitedStore(spark, str(tmp_path / "none"), ())
    arrive(spark, folder, 22, 24, 1)
    jobs.stream_new_urls(source(spark, folder).select("url"), root, state, visited=later).awaitTermination()  # the state knows u22 by now
    assert rows(jobs.read_new_urls(spark, root), "url") == [(u,) for u in want]


def test_url_dedupe_within_watermark(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, folder, 0, 10, 1)
    urls = source(spark, folder).select("url", F.col("fetched_at").alias("seen_at"))
    jobs.stream_new_urls(urls, root, state, within="1 hour").awaitTermination()
    assert rows(spark.read.parquet(root).select("url")) == rows(batch(spark, folder).select("url").distinct())


def test_counters(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for start in (0, 20):
        arrive(spark, folder, start, start + 11, 1)
        jobs.stream_counters(source(spark, folder), root, state).awaitTermination()
        expected = with_outcome(batch(spark, folder)).groupBy("outcome").count()
        assert rows(jobs.read_counters(spark, root)) == rows(expected)


def test_text_index_grows_by_segments(spark, tmp_path):
    """Pages fetched again replace their entries; a reader beside the stream sees whole segments; a merged index is the same."""
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, folder, 0, 12, 1)
    arrive(spark, folder, 6, 20, 2)
    jobs.stream_text_index(source(spark, folder), root, state).awaitTermination()
    seen = [search_text(load_text_index(spark, root), "python", limit=None).count()]
    assert live_runs(spark, root) == [(0, 1)] and compact_text_index(spark, root) is None
    arrive(spark, folder, 9, 30, 5)
    jobs.stream_text_index(source(spark, folder), root, state).awaitTermination()
    seen.append(search_text(load_text_index(spark, root), "python", limit=None).count())
    assert 0 < seen[0] < seen[1]
    whole = build_text_index(latest_pages(with_outcome(extract_pages(batch(spark, folder)))))
    for make in (lambda: any_of("python", "w3"), lambda: "w1 w1"):
        assert rows(search_text(load_text_index(spark, root), make(), None)) == rows(search_text(whole, make(), None))


def test_replayed_batch_keeps_finished_folders(spark, tmp_path):
    """A stream whose commit was lost runs its last batch again: the reader's count never falls."""
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, folder, 0, 12, 1)
    for start in (jobs.stream_text_index, jobs.stream_word_index):
        out, log = f"{root}-{start.__name__}", f"{state}-{start.__name__}"
        start(source(spark, folder), out, log).awaitTermination()
        files = sorted(p for p in (tmp_path / f"out-{start.__name__}").rglob("*.parquet"))
        commits = sorted((tmp_path / f"state-{start.__name__}" / "commits").glob("[0-9]*"))
        commits[-1].unlink()
        (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
        start(source(spark, folder), out, log).awaitTermination()
        assert sorted(p for p in (tmp_path / f"out-{start.__name__}").rglob("*.parquet")) == files
