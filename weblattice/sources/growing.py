"""Stores that streams and crawls add batches to: postings and pages.

A batch writes its own rows only. Whoever adds one also merges the parts that are due (``manifest.due``), so a reader meets few parts however many batches there
were. Of a page's fetches the latest counts, and of equal times that of the later batch, whether or not their parts are merged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weblattice import schemas
from weblattice.operators.visited import latest_pages, upsert_pages
from weblattice.sources.manifest import Manifest, Part, commit, due, newest, sweep
from weblattice.sources.snapshots import versions, write_once
from weblattice.sources.word_store import by_word

Reader = Callable[[SparkSession, str, tuple[Part, ...]], DataFrame]


def _found(spark: SparkSession, root: str) -> Manifest:
    """What a store without a manifest holds: the newest snapshot and the finished batches after it."""
    covered = max(versions(spark, root), default=-1)
    parts = [Part(0, covered, f"version={covered}")] if covered >= 0 else []
    return Manifest().with_parts("", (*parts, *[Part(n, n, f"batch={n}") for n in versions(spark, root, "batch") if n > covered]))


def live_parts(spark: SparkSession, root: str) -> tuple[Part, ...]:
    """The parts that a reader takes, oldest first."""
    return (newest(spark, root) or _found(spark, root)).parts()


def _tables(spark: SparkSession, root: str, parts: tuple[Part, ...], schema: str) -> list[DataFrame]:
    return [spark.read.schema(schema).parquet(f"{root}/{part.folder}") for part in parts] or [spark.createDataFrame([], schema)]


def words_of(spark: SparkSession, root: str, parts: tuple[Part, ...]) -> DataFrame:
    """Postings of the parts."""
    return reduce(DataFrame.unionByName, _tables(spark, root, parts, schemas.WORD_POSTINGS))


def pages_of_parts(spark: SparkSession, root: str, parts: tuple[Part, ...]) -> DataFrame:
    """One row per url. The oldest part is the longest: its text is filtered in place, only later parts are ranked."""
    oldest, *later = _tables(spark, root, parts, schemas.PAGES)
    if not later:
        return oldest
    numbered = reduce(DataFrame.unionByName, [table.withColumn("_part", F.lit(n)) for n, table in enumerate(later)])
    latest = Window.partitionBy("url").orderBy(F.desc("fetched_at"), F.desc("_part"))
    return upsert_pages(oldest, numbered.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n", "_part"))


def _merge(spark: SparkSession, root: str, parts: tuple[Part, ...], read: Reader, arrange: Callable[[DataFrame], DataFrame]) -> None:
    first, last = parts[0].first, parts[-1].last
    run = Part(first, last, f"run={first}-{last}")
    write_once(arrange(read(spark, root, parts)), f"{root}/{run.folder}")
    commit(spark, root, lambda m: m.merged(parts, run), lambda: _found(spark, root))
    sweep(spark, root)


def _add(batch: DataFrame, root: str, number: int, read: Reader, arrange: Callable[[DataFrame], DataFrame]) -> None:
    spark, found = batch.sparkSession, lambda: _found(batch.sparkSession, root)
    known = newest(spark, root)
    if known is None or not known.holds(number):  # a replayed batch leaves its folder and the merged run as they are
        part = Part(number, number, f"batch={number}")
        write_once(arrange(batch), f"{root}/{part.folder}")
        known = commit(spark, root, lambda m: m.with_part(part), found)
    # A merge that was lost is made up for by the next batch.
    wanted = due(known.parts())
    if wanted:
        _merge(spark, root, wanted, read, arrange)


def _compact(spark: SparkSession, root: str, read: Reader, arrange: Callable[[DataFrame], DataFrame]) -> int | None:
    parts = live_parts(spark, root)
    if len(parts) < 2:
        return None
    _merge(spark, root, parts, read, arrange)
    return parts[-1].last


def add_words(postings: DataFrame, root: str, number: int) -> None:
    """Store the postings as batch ``number``, sorted by word."""
    _add(postings, root, number, words_of, by_word)


def read_word_index(spark: SparkSession, root: str) -> DataFrame:
    """Postings of all finished batches; a search beside a running writer sees whole pages."""
    return words_of(spark, root, live_parts(spark, root))


def compact_word_index(spark: SparkSession, root: str) -> int | None:
    """Merge all parts into one, sorted by word, beside running readers; return its last batch, or None if there is but one part."""
    return _compact(spark, root, words_of, by_word)


def add_pages(pages: DataFrame, root: str, number: int) -> None:
    """Store the pages as batch ``number``, one row per url."""
    _add(latest_pages(pages), root, number, pages_of_parts, lambda rows: rows)


def read_page_store(spark: SparkSession, root: str) -> DataFrame:
    """The store as of the last finished batch, one row per url."""
    return pages_of_parts(spark, root, live_parts(spark, root))


def compact_page_store(spark: SparkSession, root: str) -> int | None:
    """Merge all parts into one, beside running readers; return its last batch, or None if there is but one part."""
    return _compact(spark, root, pages_of_parts, lambda rows: rows)
