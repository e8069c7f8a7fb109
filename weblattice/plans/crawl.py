"""The crawl job over captured responses: traverse, store pages, index words, count."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weblattice import schemas
from weblattice.operators.extraction import extract_pages, with_outcome
from weblattice.operators.postings import word_postings
from weblattice.operators.reports import run_counters
from weblattice.operators.robots import DEFAULT_USER_AGENT, robots_allowed, robots_rules, rules_by_host
from weblattice.operators.text_index import TextIndex, add_to_text_index, live_runs, load_parts
from weblattice.operators.visited import add_visited
from weblattice.plans.traversal import Traversal, traverse
from weblattice.runtime import materialize, new_folder
from weblattice.sources.frontier import load_frontier, save_frontier
from weblattice.sources.growing import add_pages, add_words, live_parts, pages_of_parts, words_of
from weblattice.sources.manifest import Manifest, Part, commit, newest
from weblattice.sources.snapshots import versions
from weblattice.sources.visited_store import VisitedStore

NO_RESPONSE = "no response"


@dataclass(frozen=True)
class Crawl:
    visited: DataFrame  # (url, origin_url, depth)
    frontier: DataFrame  # tasks a level budget left open
    pages: DataFrame  # page store rows plus outcome
    postings: DataFrame  # word postings of the successful pages
    counters: DataFrame  # per depth and in total


def fetch(tasks: DataFrame, extracted: DataFrame) -> DataFrame:
    """Page rows of the tasks. A url without a captured response is an error with status 0.

    Found and missing urls are two joins, so page text only takes part in an inner one: there few tasks
    can be broadcast, and many can filter the text before its shuffle. The other reads only urls.
    """
    columns = ("title", "content", "status_code", "error", "links", "bad_links", "outcome")
    found = extracted.select("url", *columns).join(tasks, "url").select("url", "origin_url", "depth", *columns)
    missing = tasks.join(extracted.select("url"), "url", "left_anti").select(
        "url", "origin_url", "depth", F.lit("").alias("title"), F.lit("").alias("content"), F.lit(0).alias("status_code"),
        F.lit(NO_RESPONSE).alias("error"), F.array().cast("array<string>").alias("links"), F.lit(0).alias("bad_links"),
        F.lit("error").alias("outcome"),
    )
    return found.unionByName(missing)


def one_capture(responses: DataFrame) -> DataFrame:
    """One response per url, as a fetch takes place once: the latest ``captured_at`` if there is such a column; ties by the other columns.

    Captures are compared by their narrow columns and a hash of the body, and cut in the map tasks; bodies are only shuffled if some url repeats.
    """
    columns = [F.desc(c) for c in ("captured_at", "status_code", "content_type", "error") if c in responses.columns]
    narrow = responses.withColumn("_body", F.xxhash64("body")).drop("body")
    if not narrow.groupBy("url").count().filter("count > 1").limit(1).count():
        return responses
    latest = Window.partitionBy("url").orderBy(*columns, "_body")
    chosen = responses.withColumn("_body", F.xxhash64("body")).withColumn("_n", F.row_number().over(latest))
    return chosen.filter("_n = 1").drop("_n", "_body")


def extraction(responses: DataFrame, path: str | None = None, whole_text: bool = False) -> DataFrame:
    """The parsed responses, one per url, as a stored table that any number of crawls can read; ``whole_text`` as in ``extract_pages``."""
    path = path or new_folder(responses.sparkSession, "extracted")
    return materialize(with_outcome(extract_pages(one_capture(responses), whole_text)), path)


def crawl(
    responses: DataFrame,
    seeds: DataFrame | None,
    max_depth: int,
    robots: DataFrame | None = None,
    *,
    user_agent: str = DEFAULT_USER_AGENT,
    visited: DataFrame | VisitedStore | None = None,
    frontier: DataFrame | None = None,
    levels: int | None = None,
    extracted: bool = False,
) -> Crawl:
    """Crawl captured ``responses`` from the seeds to ``max_depth``. Of several captures of a url, one is taken (``one_capture``).

    Bodies are parsed once, in one pass over all responses, and the result is written to the shared
    folder; the levels then read only its url and link columns. The page rows are written out as well,
    for the postings and counters to read. A url that robots rules forbid stays in
    the visited set but has no page row and no children. ``extracted`` says that the responses are a table
    of ``extraction``, so a resumed crawl parses nothing again.
    """
    spark = responses.sparkSession
    parsed = responses if extracted else extraction(responses)
    rules = None
    expandable = parsed.filter(F.col("outcome") == "success").select("url", "links")
    if robots is not None:
        rules = materialize(rules_by_host(robots_rules(robots, user_agent)), new_folder(spark, "robots"))
        expandable = robots_allowed(expandable, rules)
    edges = expandable.select(F.col("url").alias("src"), F.explode("links").alias("dst"))
    run: Traversal = traverse(edges, max_depth, seeds, visited=visited, frontier=frontier, levels=levels)
    processed = run.processed if rules is None else robots_allowed(run.processed, rules)
    pages = fetch(processed, parsed).withColumn("fetched_at", F.current_timestamp())
    pages = materialize(pages, new_folder(spark, "crawled"))
    return Crawl(
        visited=run.visited,
        frontier=run.frontier,
        pages=pages,
        postings=word_postings(pages),
        counters=run_counters(run.visited, pages),
    )


def visited_store(spark: SparkSession, root: str) -> VisitedStore:
    """The visited urls of all finished runs of ``crawl_into``."""
    return VisitedStore(spark, f"{root}/visited", tuple(versions(spark, f"{root}/frontier")))


def read_visited(spark: SparkSession, root: str) -> DataFrame:
    """``(url, origin_url, depth, discovered_at)`` of all finished runs of ``crawl_into``."""
    return visited_store(spark, root).all()


def crawl_into(
    root: str,
    extracted: DataFrame,
    seeds: DataFrame | None,
    max_depth: int,
    robots: DataFrame | None = None,
    *,
    user_agent: str = DEFAULT_USER_AGENT,
    levels: int | None = None,
    stem: bool = True,
) -> Crawl:
    """Crawl on with the stores under ``root``, and keep the result in them.

    The run resumes the saved frontier if there is one, else it starts from the seeds, and never enters a url visited before. It adds
    its pages to the page store ``pages`` (``streaming.jobs.read_page_store``), its postings to ``words`` (``read_word_index``), a segment to the
    full-text index ``text`` and its urls to ``visited``; what is left to do replaces ``frontier``, and nothing left clears it. Each store
    gets one new part, so a run costs what it brings. The frontier ends the run: a run that was lost before that is made again. A manifest of
    all stores follows (``open_stores``).
    """
    spark = extracted.sparkSession
    number = max(versions(spark, f"{root}/frontier"), default=-1) + 1
    visited = visited_store(spark, root)
    run = crawl(
        extracted, seeds, max_depth, robots, user_agent=user_agent, visited=visited,
        frontier=load_frontier(spark, f"{root}/frontier"), levels=levels, extracted=True,
    )
    pages = run.pages.select(*[part.split()[0] for part in schemas.PAGES.split(", ")])
    add_pages(pages, f"{root}/pages", number)
    add_words(run.postings, f"{root}/words", number)
    add_to_text_index(spark, f"{root}/text", pages, stem, number)
    visited.add(add_visited(spark.createDataFrame([], schemas.VISITED), run.visited), number)
    save_frontier(run.frontier, f"{root}/frontier")
    publish_stores(spark, root, number)
    return run


def publish_stores(spark: SparkSession, root: str, number: int) -> None:
    """Name the parts of all stores as they are after run ``number``, in one manifest."""
    tables = {name: live_parts(spark, f"{root}/{name}") for name in ("pages", "words")}
    tables["text"] = tuple(Part(first, last, "") for first, last in live_runs(spark, f"{root}/text"))
    tables["visited"] = tuple(Part(n, n, f"batch={n}") for n in versions(spark, f"{root}/frontier"))
    commit(spark, root, lambda m: None if any(p.last > number for p in m.parts("visited")) else replace(m, tables=tables))


@dataclass(frozen=True)
class Stores:
    """All stores of ``crawl_into`` as of one finished run. They stay so while later runs add to them and merge."""

    spark: SparkSession
    root: str
    manifest: Manifest

    def pages(self) -> DataFrame:
        return pages_of_parts(self.spark, f"{self.root}/pages", self.manifest.parts("pages"))

    def words(self) -> DataFrame:
        return words_of(self.spark, f"{self.root}/words", self.manifest.parts("words"))

    def text(self, stem: bool = True) -> TextIndex:
        return load_parts(self.spark, f"{self.root}/text", self.manifest.parts("text"), stem)

    def visited(self) -> VisitedStore:
        return VisitedStore(self.spark, f"{self.root}/visited", tuple(p.last for p in self.manifest.parts("visited")))


def open_stores(spark: SparkSession, root: str) -> Stores:
    """The stores under ``root`` as the newest manifest names them: one file is read, and all tables are of the same run."""
    return Stores(spark, root, newest(spark, root) or Manifest())
