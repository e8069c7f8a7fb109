"""Traversal, crawl job, url sets, page store, checkpoints."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import oracles
from support import rows
from weblattice import runtime, schemas
from weblattice.operators.reports import frontier_size, run_counters, store_report
from weblattice.operators.visited import add_visited, new_urls, pending, upsert_pages
from weblattice.operators.text_index import load_text_index
from weblattice.operators.text_search import search_text
from weblattice.plans.crawl import crawl, crawl_into, extraction, read_visited
from weblattice.plans.registry import crawl_job, crawl_postings
from weblattice.plans.traversal import traverse, traverse_in_turn
from weblattice.runtime import materialize
from weblattice.sources.frontier import clear_frontier, load_frontier, save_frontier
from weblattice.sources.responses import seeds_from
from weblattice.sources.snapshots import read_latest, versions, write_version
from weblattice.streaming.jobs import read_page_store, read_word_index

HTML = "text/html"


def edge_frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), schemas.EDGES)


def reference_walk(edges, seeds, depth, closed=()):
    """Plain breadth-first search with several seeds, in seed order."""
    out = {s: (s, 0) for s in seeds if s not in closed}
    level = list(out)
    for d in range(depth):
        found = {}
        for url in level:
            for src, dst in edges:
                if src == url and dst not in out and dst not in closed:
                    origin = out[url][0]
                    if dst not in found or seeds.index(origin) < seeds.index(found[dst]):
                        found[dst] = origin
        out.update({u: (o, d + 1) for u, o in found.items()})
        level = list(found)
    return sorted((u, o, d) for u, (o, d) in out.items())


def test_cycle_and_bounds(spark):
    edges = edge_frame(spark, ("A", "B"), ("B", "A"), ("B", "C"))
    assert rows(traverse(edges, 5, seeds_from(spark, "A")).visited) == [("A", "A", 0), ("B", "A", 1), ("C", "A", 2)]
    assert rows(traverse(edges, 0, seeds_from(spark, "A")).visited) == [("A", "A", 0)]
    with pytest.raises(ValueError):
        traverse(edges, -1, seeds_from(spark, "A"))


def test_random_graphs(spark):
    pick = random.Random(5)
    nodes = [f"n{i}" for i in range(40)]
    pairs = [(pick.choice(nodes), pick.choice(nodes)) for _ in range(70)]
    pairs += [(n, "n0") for n in nodes]  # one url that every page links to
    edges, seeds = edge_frame(spark, *pairs), ["n7", "n3", "n11"]
    got = traverse(edges, 4, seeds_from(spark, *seeds))
    assert rows(got.visited) == reference_walk(pairs, seeds, 4)
    assert rows(got.processed) == rows(got.visited) and got.frontier.count() == 0
    turns = traverse_in_turn(edges, 3, [seeds_from(spark, "n7"), seeds_from(spark, "n3"), seeds_from(spark, "n7")])
    first = reference_walk(pairs, ["n7"], 3)
    assert rows(turns.visited) == sorted(first + reference_walk(pairs, ["n3"], 3, {u for u, _, _ in first}))


def test_stop_and_resume(spark, tmp_path):
    pick = random.Random(9)
    pairs = [(f"n{pick.randint(0, 30)}", f"n{pick.randint(0, 30)}") for _ in range(50)]
    edges, seeds, root = edge_frame(spark, *pairs), ["n1", "n2"], str(tmp_path / "frontier")
    whole = reference_walk(pairs, seeds, 6)
    first = traverse(edges, 6, seeds_from(spark, *seeds), levels=2)
    assert save_frontier(first.frontier, root) == first.frontier.count()
    assert rows(first.frontier, "url", "depth") == [(u, d) for u, _, d in whole if d == 2]
    rest = traverse(edges, 6, seeds_from(spark, "ignored"), visited=first.visited, frontier=load_frontier(spark, root))
    assert rows(first.visited.unionByName(rest.visited)) == whole
    assert rows(first.processed.unionByName(rest.processed)) == whole
    short = traverse(edges, 1, frontier=load_frontier(spark, root))
    assert short.processed.count() == 0  # saved tasks beyond the depth bound are not taken up
    clear_frontier(spark, root)
    assert load_frontier(spark, root).count() == 0
    again = traverse(edges, 6, seeds_from(spark, *seeds), visited=first.visited, frontier=load_frontier(spark, root))
    assert again.visited.count() == 0  # the seeds were visited before


def test_mixed_depth_frontier(spark):
    edges = edge_frame(spark, ("a", "b"), ("b", "c"), ("x", "c"), ("c", "d"))
    frontier = spark.createDataFrame([("a", "o1", 0), ("x", "o2", 2)], schemas.TASKS)
    run = traverse(edges, 4, frontier=frontier)
    assert rows(run.visited) == [("b", "o1", 1), ("c", "o1", 2), ("d", "o1", 3)]
    assert rows(run.processed, "url") == [("a",), ("b",), ("c",), ("d",), ("x",)]


def test_crawl_with_robots(spark):
    page = lambda *links: "<title>t</title>" + "".join(f'<a href="{u}">word</a> ' for u in links)
    responses = spark.createDataFrame([
        ("http://h/", 200, HTML, page("/a", "/private/x", "/gone", "http://g/#top", "/a", "mailto:q"), None),
        ("http://h/a", 200, HTML, page("/b", "/"), None),
        ("http://h/b", 200, HTML, page("/c"), None),
        ("http://h/private/x", 200, HTML, page("/hidden"), None),
        ("http://g/", 500, HTML, page("/never"), None),
        ("http://h/c", 200, "text/plain", page("/d"), None),
    ], schemas.RESPONSES)
    robots = spark.createDataFrame([("http://h", 200, "User-agent: *\nDisallow: /private/")], schemas.ROBOTS)
    run = crawl(responses, seeds_from(spark, " http://h/#x "), 2, robots)
    assert rows(run.visited, "url", "depth") == [
        ("http://g/", 1), ("http://h/", 0), ("http://h/a", 1), ("http://h/b", 2), ("http://h/gone", 1), ("http://h/private/x", 1),
    ]
    assert rows(run.pages, "url", "status_code", "outcome") == [
        ("http://g/", 500, "http_error"), ("http://h/", 200, "success"), ("http://h/a", 200, "success"),
        ("http://h/b", 200, "success"), ("http://h/gone", 0, "error"),
    ]
    assert rows(run.postings, "word", "url", "frequency") == [
        ("word", "http://h/", 6), ("word", "http://h/a", 2), ("word", "http://h/b", 1),
    ]
    totals = run.counters.filter("depth IS NULL").collect()[0]
    assert (totals["crawled_pages"], totals["error_pages"], totals["discovered_urls"]) == (3, 2, 6)
    assert rows(store_report(run.pages, run.visited)) == [(5, 2, 6)]
    part = crawl(responses, seeds_from(spark, "http://h/"), 2, robots, levels=1)
    assert rows(part.pages, "url") == [("http://h/",)] and part.frontier.count() == 4
    rest = crawl(responses, None, 2, robots, visited=part.visited, frontier=part.frontier)
    assert rows(part.pages.unionByName(rest.pages), "url", "depth", "outcome") == rows(run.pages, "url", "depth", "outcome")


def test_crawl_postings_of_whole_plain_text(spark, tmp_path):
    """Words far behind the excerpt of a plain page are postings too; the stored page of ``crawl_job`` keeps its excerpt."""
    plain = "early " * 166 + "cutword " + "late " * 5000 + "<b>End</b>"  # the excerpt ends inside cutword
    bodies = {6: "<p>early</p>" + "<i>late</i> " * 3000, 8: plain, 9: "lost", 18: "", 28: None}
    pages = [(i, f"http://x.hosts/{i}#top", bodies.get(i, f"<p>page{i}</p>")) for i in (*range(10), 18, 28)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = crawl_postings(spark, str(tmp_path)).cache()
    assert rows(found.filter("url = 'http://x.hosts/8'"), "word", "frequency") == [
        ("18", 1), ("cutword", 1), ("early", 166), ("end", 1), ("hosts", 1), ("href", 1), ("http", 1), ("late", 5000), ("next", 1), ("top", 1),
    ]
    assert rows(found.filter("url = 'http://x.hosts/6'"), "word", "frequency") == [("early", 1), ("late", 3000)]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert rows(found) == sorted(db.execute(oracles.oracle_sql()["crawl_postings"]).fetchall())
    assert rows(crawl_job(spark, str(tmp_path)).filter("url = 'http://x.hosts/8'"), "n_tokens") == [(167,)]


def test_url_sets(spark):
    visited = spark.createDataFrame([("a", "o", 0)], schemas.TASKS).withColumn("discovered_at", F.current_timestamp())
    found = spark.createDataFrame([("a", "o", 1), ("b", "p", 2), ("b", "o", 1), ("b", "o", 1), ("c", "o", 3)], schemas.TASKS)
    fresh = new_urls(found, visited)
    assert rows(fresh) == [("b", "o", 1), ("c", "o", 3)]
    grown = add_visited(visited, fresh)
    assert rows(grown, "url") == [("a",), ("b",), ("c",)] and new_urls(found, grown).count() == 0
    assert rows(pending(grown, visited), "url") == [("b",), ("c",)]
    assert rows(frontier_size(grown, visited)) == [(2,)]


def test_upsert_last_write_wins(spark):
    def frame(*items):
        return spark.createDataFrame([(u, c, d, e) for u, c, d, e in items], "url string, content string, day int, error string").selectExpr(
            "url", "'o' AS origin_url", "0 AS depth", "'t' AS title", "content", "200 AS status_code", "error",
            "make_timestamp(2024, 1, day, 0, 0, 0) AS fetched_at",
        )

    store = frame(("a", "old", 1, None), ("b", "keep", 5, None))
    fetched = frame(("a", "", 2, "timed out"), ("a", "new", 3, None), ("b", "late", 4, None), ("c", "x", 1, None))
    assert rows(upsert_pages(store, fetched), "url", "content", "error") == [("a", "new", None), ("b", "keep", None), ("c", "x", None)]
    error_wins = upsert_pages(store, frame(("a", "", 9, "timed out")))
    assert rows(error_wins, "url", "content", "error") == [("a", "", "timed out"), ("b", "keep", None)]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "store")
    one, two = spark.range(3), spark.range(5)
    assert read_latest(spark, root, "id bigint").count() == 0
    assert write_version(one, root) == 0 and write_version(two, root) == 1
    (tmp_path / "store" / "version=2").mkdir()  # a write that never finished
    assert versions(spark, root) == [0, 1]
    assert read_latest(spark, root, "id bigint").count() == 5


def test_counters_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.TASKS)
    pages = spark.createDataFrame([], "depth int, error string")
    assert run_counters(empty, pages).filter("depth IS NOT NULL").count() == 0


def test_crawl_into_stores_resumes_and_reruns(spark, tmp_path):
    """Stopped, resumed, run again and given new seeds, the stores hold what one crawl gives; a lost run is made again."""
    root = str(tmp_path / "stores")
    pages = [(f"http://h/{i}", 200, HTML, f'<p>word{i} common<a href="/{i + 1}">x</a><a href="/{i * 2}">y</a>', None) for i in range(12)]
    responses = spark.createDataFrame(pages, schemas.RESPONSES)
    parsed = extraction(responses, str(tmp_path / "parsed"))
    seeds = seeds_from(spark, "http://h/0")
    whole = crawl(responses, seeds, 5)
    first = crawl_into(root, parsed, seeds, 5, levels=2)
    assert first.frontier.count() and len(versions(spark, f"{root}/frontier")) == 1
    crawl_into(root, parsed, seeds, 5)
    again = crawl_into(root, parsed, seeds, 5)
    assert again.pages.count() == 0 and load_frontier(spark, f"{root}/frontier").isEmpty()
    assert rows(read_visited(spark, root), "url", "origin_url", "depth") == rows(whole.visited)
    store = read_page_store(spark, f"{root}/pages")
    assert rows(store.fillna("-"), "url", "depth", "content", "status_code") == rows(whole.pages, "url", "depth", "content", "status_code")
    assert rows(read_word_index(spark, f"{root}/words")) == rows(whole.postings)
    text = load_text_index(spark, f"{root}/text")
    assert rows(search_text(text, "common", None), "url") == rows(whole.pages.filter("error IS NULL"), "url")
    # Without its frontier, the last part, a run does not count.
    more = seeds_from(spark, "http://h/11")
    crawl_into(root, parsed, more, 0)
    (tmp_path / "stores" / "frontier" / "version=3" / "_SUCCESS").unlink()
    assert rows(read_visited(spark, root), "url") == rows(whole.visited, "url")
    crawl_into(root, parsed, more, 0)
    assert rows(read_visited(spark, root), "url") == sorted(set(rows(whole.visited, "url")) | {("http://h/11",)})


def test_local_folder_without_a_setting(spark, monkeypatch):
    monkeypatch.setattr(runtime, "CHECKPOINT_DIR", "spark.no.such.setting")
    root = runtime.shared_root(spark)
    assert root == runtime.shared_root(spark) and materialize(spark.range(3), runtime.new_folder(spark, "x")).count() == 3
