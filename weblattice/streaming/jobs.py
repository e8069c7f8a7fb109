"""Streams over arriving responses: word index, full-text index, page store, url dedupe, counters.

Sinks write one folder per batch id, and name it in a manifest. A batch that is replayed after a lost driver finds itself named and leaves its folder as it is,
so readers never lose a file; an unfinished one is written again. With ``available_now`` a stream takes what is there and ends, and gives what the batch
operators give on the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from weblattice.operators.extraction import extract_pages, with_outcome
from weblattice.operators.postings import word_postings
from weblattice.operators.text_index import add_to_text_index
from weblattice.runtime import materialize, new_folder
from weblattice.sources.growing import (  # noqa: F401  (readers of these streams)
    add_pages, add_words, compact_page_store, compact_word_index, read_page_store, read_word_index,
)
from weblattice.sources.snapshots import read_latest, remove, versions, write_once, write_version
from weblattice.sources.visited_store import VisitedStore

_PAGE_COLUMNS = ("url", "origin_url", "depth", "title", "content", "status_code", "error", "fetched_at")


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def pages_of(responses: DataFrame) -> DataFrame:
    """Extracted pages of a stream (or table) of responses that carries ``origin_url`` and ``depth``."""
    return with_outcome(extract_pages(responses))


def stream_word_index(responses: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Each arriving page appends its word postings, sorted by word. No state: the count happens inside the page row."""
    postings = word_postings(pages_of(responses))

    def append(batch: DataFrame, batch_id: int) -> None:
        add_words(batch, root, batch_id)

    return _start(postings.writeStream.foreachBatch(append), checkpoint, available_now)


def stream_text_index(responses: DataFrame, root: str, checkpoint: str, stem: bool = True, available_now: bool = True) -> StreamingQuery:
    """Each batch is a segment of the full-text index at ``root`` and replaces older entries of its urls.

    Search it beside the stream with ``load_text_index``; ``compact_text_index`` merges segments. ``responses`` carries ``fetched_at``;
    a later batch wins over an earlier one, as the write of a page does.
    """
    pages = pages_of(responses).select(*_PAGE_COLUMNS)

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read by each table of the segment, parsed once
        try:
            add_to_text_index(batch.sparkSession, root, batch, stem, batch_id)
        finally:
            batch.unpersist()

    return _start(pages.writeStream.foreachBatch(add), checkpoint, available_now)


def stream_page_upsert(responses: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the page store up to date. ``responses`` carries ``fetched_at``.

    A batch writes only its own pages, one row per url, and merges parts that are due, so a page is rewritten a few times however many batches follow.
    Readers let the latest fetch of a url win.
    """
    pages = pages_of(responses).select(*_PAGE_COLUMNS)

    def add(batch: DataFrame, batch_id: int) -> None:
        add_pages(batch, root, batch_id)

    return _start(pages.writeStream.foreachBatch(add), checkpoint, available_now)


def stream_new_urls(
    urls: DataFrame, root: str, checkpoint: str, available_now: bool = True, within: str | None = None, visited: VisitedStore | None = None
) -> StreamingQuery:
    """Pass each url on once. Exact and unbounded like the visited set, so its state grows with the urls.

    ``within`` bounds the state by event time ``seen_at`` and misses repeats that lie further apart. With the ``visited`` urls of a crawl, none that the
    crawl knows is passed on: they stay where they are stored, and a batch opens only pieces that may hold one of its urls, so the state holds
    urls of the stream only and a start costs nothing. Read that form with ``read_new_urls``.
    """
    if within is None:
        once = urls.dropDuplicates(["url"])
    else:
        once = urls.withWatermark("seen_at", within).dropDuplicatesWithinWatermark(["url"])
    if visited is None:
        return _start(once.writeStream.format("parquet").option("path", root).outputMode("append"), checkpoint, available_now)

    def add(batch: DataFrame, batch_id: int) -> None:
        folder = new_folder(batch.sparkSession, "stream-urls")
        write_once(visited.unknown(materialize(batch, folder)), f"{root}/batch={batch_id}")  # looked up twice, taken from the stream once
        remove(batch.sparkSession, folder)

    return _start(once.writeStream.foreachBatch(add), checkpoint, available_now)


def read_new_urls(spark: SparkSession, root: str, schema: str = "url string") -> DataFrame:
    """What a stream beside a ``visited`` set has passed on in its finished batches."""
    done = versions(spark, root, "batch")
    return spark.read.schema(schema).parquet(*[f"{root}/batch={n}" for n in done]) if done else spark.createDataFrame([], schema)


def stream_counters(responses: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Running page counts per outcome; the newest version holds the totals so far."""
    # The outcome needs no parsing, so no body is read.
    outcomes = with_outcome(responses.select("url", "status_code", "error"))
    counts = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("pages"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, root, batch_id)

    return _start(counts.writeStream.outputMode("complete").foreachBatch(publish), checkpoint, available_now)


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, "outcome string, pages bigint")
