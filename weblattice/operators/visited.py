"""URL sets and the page store: new urls, visited set, pending set, page upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weblattice.runtime import materialize, new_folder


def new_urls(discovered: DataFrame, visited: DataFrame) -> DataFrame:
    """Urls not visited before, once each: ``(url, origin_url, depth)`` of the first discovery.

    First means smallest depth, then origin. The row_number filter cuts duplicates in the map tasks, so
    a url that a third of all links point to is not a hot key.
    """
    first = Window.partitionBy("url").orderBy("depth", "origin_url")
    return (
        discovered.select("url", "origin_url", "depth")
        .withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
        .join(visited.select("url"), "url", "left_anti")
    )


def add_visited(visited: DataFrame, found: DataFrame) -> DataFrame:
    """The visited set with the urls of ``new_urls`` added."""
    stamped = found.withColumn("discovered_at", F.current_timestamp())
    return visited.unionByName(stamped.select(*visited.columns))


def pending(discovered: DataFrame, processed: DataFrame) -> DataFrame:
    """Discovered urls that were not processed."""
    return discovered.join(processed.select("url"), "url", "left_anti")


def _at(column: str):
    """The time of a fetch; none is before all others."""
    return F.coalesce(column, F.lit("0001-01-01").cast("timestamp"))


def latest_pages(fetched: DataFrame) -> DataFrame:
    """One row per url, all columns from the latest fetch; rows of equal time are told apart by their other columns."""
    rest = [c for c in fetched.columns if c not in ("url", "fetched_at")]
    latest = Window.partitionBy("url").orderBy(F.desc("fetched_at"), *[F.desc(c) for c in rest])
    return fetched.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def upsert_pages(store: DataFrame, fetched: DataFrame) -> DataFrame:
    """New snapshot of the page store (one row per url): the latest fetch of a url wins, and of equal times the new one.

    The store is compared by url and time only. The urls to replace are written out, so the planner knows their size: its
    text is filtered in place as long as they can be broadcast, and shuffled only for a batch that is as large as the store.
    """
    spark = store.sparkSession
    new = latest_pages(fetched).select(*store.columns)
    times = materialize(new.select("url", _at("fetched_at").alias("_new")), new_folder(spark, "fetched-urls"))
    known = store.select("url", _at("fetched_at").alias("_old")).join(times, "url")
    known = materialize(known.select("url", (F.col("_new") >= F.col("_old")).alias("_replaced")), new_folder(spark, "known-urls"))
    kept = store.join(known.filter("_replaced").select("url"), "url", "left_anti")
    return kept.unionByName(new.join(known.filter("NOT _replaced").select("url"), "url", "left_anti"))
