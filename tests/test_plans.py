"""Plan shapes that matter at scale."""

import contextlib
import datetime
import io
import re

import pytest
from pyspark.sql import functions as F

from support import rows
from weblattice import schemas
from weblattice.operators.postings import word_postings
from weblattice.operators import word_search
from weblattice.operators.robots import robots_rules, with_robots
from weblattice.operators.text_index import build_text_index, save_text_index
from weblattice.operators.text_search import all_of, phrase, search_text, search_text_batch
from weblattice.operators.visited import new_urls, upsert_pages
from weblattice.operators.word_search import search_words, search_words_batch
from weblattice.plans import traversal
from weblattice.plans.traversal import _expand, _steps, store_edges
from weblattice.runtime import materialize, new_folder
from weblattice.sources.word_store import read_postings, write_postings


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.range(200).selectExpr(
        "concat('http://h/', id) AS url", "'http://h/' AS origin_url", "cast(id % 4 AS int) AS depth", "'red' AS title",
        "concat('the dog number ', id, if(id % 3 = 0, ' fox', '')) AS content",
    )


def test_index_builds_are_map_only(pages):
    index = build_text_index(pages, stem=False)
    for frame in (word_postings(pages), index.postings, index.frequencies, index.documents):
        assert "Exchange" not in plan(frame)


def test_word_filter_reaches_the_scan(spark, pages, tmp_path):
    write_postings(word_postings(pages), str(tmp_path / "p"))
    text = plan(search_words(read_postings(spark, str(tmp_path / "p")), "fox", limit=5))
    assert "EqualTo(word,fox)" in text and "TakeOrderedAndProject" in text and "origin_url" not in text.split("ReadSchema")[1]


def test_top_k_is_cut_before_the_shuffle(spark, pages):
    queries = spark.createDataFrame([(1, "dog")], "query_id int, query string")
    store = pages.selectExpr("url", "origin_url", "depth", "title", "content", "200 AS status_code", "cast(null AS string) AS error", "current_timestamp() AS fetched_at")
    found = pages.select("url", "origin_url", "depth")
    ranked = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(word_search, "materialize", lambda frame, path: ranked.append(frame) or frame)
        search_words_batch(word_postings(pages), queries)
    for frame in (ranked[-1], upsert_pages(store, store), new_urls(found, found.limit(0))):
        text = plan(frame)
        assert text.count("WindowGroupLimit") >= 2, text


def test_search_shuffles_hits_once(spark, pages, tmp_path):
    index = save_text_index(build_text_index(pages, stem=False), str(tmp_path / "i"))
    frame = search_text(index, all_of("dog", "fox"))
    frame.collect()
    text = plan(frame)
    assert "In(term, [dog,fox])" in text and "CartesianProduct" not in text
    assert "ReusedExchange" in text.split("Initial Plan")[0]


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "8",
    }
    new = "spark.sql.adaptive.autoBroadcastJoinThreshold"  # has no value before
    before = {key: spark.conf.get(key) for key in limits if key != new}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    spark.conf.unset(new)
    for key, value in before.items():
        spark.conf.set(key, value)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_host_is_split(spark, small_skew_limits):
    """One host with most urls: its partition of the robots join is split, not run by one task."""
    urls = spark.range(60000, numPartitions=8).selectExpr(
        "if(id % 10 < 7, 0, id) AS host", "concat('http://h', if(id % 10 < 7, 0, id), '/p', id) AS url"
    )
    robots = spark.range(500).selectExpr("concat('http://h', id) AS host_key", "200 AS status_code", "'User-agent: *\nDisallow: /p1' AS body")
    frame = with_robots(urls, robots_rules(robots))
    assert frame.filter("NOT allowed").count() == urls.filter("host < 500 AND url LIKE '%/p1%'").count()
    assert "skew=true" in executed(frame)


def test_hot_word(spark, small_skew_limits):
    """A word most postings hold and most queries ask for: no join takes it to one task."""
    postings = spark.range(60000, numPartitions=8).selectExpr(
        "if(id % 10 < 7, 'hot', concat('w', id % 1000)) AS word", "concat('u', id) AS url", "'o' AS origin_url", "1 AS depth",
        "cast(id % 50 AS int) AS frequency",
    )
    queries = spark.range(30000, numPartitions=8).selectExpr("id AS query_id", "if(id % 10 < 7, 'hot', concat('w', id % 1000)) AS query")
    frame = search_words_batch(postings, queries, limit=3)
    assert "skew=true" in executed(frame)  # the queries of the hot word
    few = rows(frame)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert rows(search_words_batch(postings, queries, limit=3)) == few and len(few) == 30000 * 3
    everything = search_words_batch(postings, queries.limit(5), limit=None)
    assert everything.filter("position is not null").count() == 0 and everything.count() > 5 * 3


def test_edges_stay_in_their_buckets(spark, small_skew_limits, monkeypatch):
    """A page with most of the links: levels shuffle the frontier only, the edges are not even sorted, and the hot page is read by several tasks."""
    monkeypatch.setattr(traversal, "HEAVY_LINKS", 5000)
    edges = spark.range(60000, numPartitions=8).selectExpr("if(id % 10 < 7, 'hub', concat('s', id)) AS src", "concat('d', id) AS dst")
    current = spark.range(2000).selectExpr("if(id = 0, 'hub', concat('s', id)) AS url", "id AS seed_ord")
    store = store_edges(edges.unionByName(spark.createDataFrame([(None, "nowhere")], "src string, dst string")))
    try:
        share = -(-60000 // int(spark.conf.get("spark.sql.shuffle.partitions")))
        assert rows(store.heavy) == [("hub", -(-42000 // max(share, 5000)))]
        steps = _steps(current, store)
        tree = plan(steps)
        frontier = [n for n in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", tree)]
        assert frontier and not any("dst" in columns for columns in frontier)
        assert not any("dst" in columns for columns in re.findall(r"\) Sort(?: \[.*\])?\nInput \[\d+\]: \[(.*?)\]\n", tree))
        assert steps.filter("seed_ord = 0").select(F.spark_partition_id()).distinct().count() > 1
        found = _expand(current, store, current.select("url"))
        assert found.count() == edges.join(current, F.col("src") == F.col("url")).select("dst").distinct().count()
        assert found.filter("seed_ord = 0").count() == 42000
    finally:
        store.drop()


def test_edges_without_a_heavy_source_stay_in_their_buckets(spark, small_skew_limits):
    """A level that is too large to broadcast is shuffled to the edges, also where no source is split."""
    edges = spark.range(20000, numPartitions=8).selectExpr("concat('s', id % 5000) AS src", "concat('d', id) AS dst")
    current = spark.range(2000).selectExpr("concat('s', id) AS url", "id AS seed_ord")
    store = store_edges(edges)
    try:
        assert store.heavy is None
        for steps in (_steps(current, store), _steps(current, store, ("s0", "s999"))):
            shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan(steps))
            assert shuffled and not any("dst" in columns for columns in shuffled)
            assert steps.count() == 8000
    finally:
        store.drop()


def test_batch_without_broadcast(spark, pages, small_skew_limits):
    """The shuffled form gives the same as the broadcast form."""
    index = build_text_index(pages, stem=False)
    queries = spark.createDataFrame([(1, "the fox"), (2, "number 7 dog")], "query_id int, query string")
    shuffled = rows(search_text_batch(index, queries, limit=5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert rows(search_text_batch(index, queries, limit=5)) == shuffled


def test_schemas_match(spark, pages):
    index = build_text_index(pages)
    for frame, schema in (
        (index.documents, schemas.TEXT_DOCUMENTS), (index.postings, schemas.TEXT_POSTINGS), (word_postings(pages), schemas.WORD_POSTINGS)
    ):
        assert frame.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()


def test_upsert_leaves_the_text_of_the_store_where_it_is(spark):
    """A small batch: no exchange below the store's side, and the right rows."""
    columns = "url string, origin_url string, depth int, title string, content string, status_code int, error string, fetched_at timestamp"
    store = spark.range(2000).selectExpr(
        "concat('u', id) AS url", "'o' AS origin_url", "0 AS depth", "'t' AS title", "concat('old ', id) AS content", "200 AS status_code",
        "cast(null AS string) AS error", "timestamp '2024-01-02 00:00:00' AS fetched_at")
    path = new_folder(spark, "test-store")
    store = materialize(store, path)
    day = lambda d: datetime.datetime(2024, 1, d)
    batch = spark.createDataFrame([
        ("u1", "o", 0, "t", "new", 200, None, day(3)), ("u1", "o", 0, "t", "newer", 200, None, day(4)), ("u2", "o", 0, "t", "stale", 200, None, day(1)),
        ("u3", "o", 0, "t", "same time", 200, None, day(2)), ("x", "o", 0, "t", "fresh", 200, None, None)], columns)
    merged = upsert_pages(store, batch)
    got = {r["url"]: r["content"] for r in merged.collect()}
    assert len(got) == merged.count() == 2001
    assert (got["u1"], got["u2"], got["u3"], got["u4"], got["x"]) == ("newer", "old 2", "same time", "old 4", "fresh")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan(upsert_pages(store, batch)))
    assert sum("content" in columns for columns in shuffled) == 1  # the batch's own rows, to find the latest of each url


def test_saved_stems_are_a_filter_of_the_scan(spark, pages, tmp_path):
    index = save_text_index(build_text_index(pages), str(tmp_path / "stemmed"))
    frame = search_text(index, phrase("number", prefix=True))
    assert "StringStartsWith(stem,number)" in plan(frame)
    assert rows(frame) == rows(search_text(build_text_index(pages), phrase("number", prefix=True)))


def test_a_level_reads_its_range_of_the_edges(spark, small_skew_limits):
    """Edges lie sorted by source; the filter on the level's range reaches the scan and loses no link."""
    edges = spark.range(3000).selectExpr("concat(substr('abc', 1 + cast(id % 3 AS int), 1), ':', id) AS src", "concat('d', id) AS dst")
    store = store_edges(edges)
    try:
        current = spark.createDataFrame([("b:1", 0), ("b:4", 0), (None, 0)], "url string, seed_ord bigint")
        steps = _steps(current, store, ("b:1", "b:4"))
        assert "GreaterThanOrEqual(src,b:1)" in plan(steps) and "LessThanOrEqual(src,b:4)" in plan(steps)
        assert rows(steps) == rows(_steps(current, store)) == [("d1", 0), ("d4", 0)]
    finally:
        store.drop()
    # Urls beyond ASCII, in an order of their own in UTF-16, at both ends of a level; levels that meet a resumed frontier.
    names = ["a", "￮", "\U0001f600", "z", "é"]
    chain = spark.createDataFrame(list(zip(["s"] * 5, names)) + list(zip(names, [f"t{n}" for n in names])), "src string, dst string")
    start = spark.createDataFrame([("s", "s", 0, 0), ("far", "s", 1, 0)], "url string, origin_url string, depth int, seed_ord bigint")
    far = spark.createDataFrame([("far", "near")], "src string, dst string")
    got = traversal.traverse(chain.unionByName(far), 3, frontier=start).processed
    expected = [("s", 0), ("far", 1), *[(n, 1) for n in names], *[(f"t{n}", 2) for n in names], ("near", 2)]
    assert rows(got, "url", "depth") == sorted(expected)
