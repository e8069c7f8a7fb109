"""Crawl reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weblattice.functions.urls import host_key


def error_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("error").isNotNull())


def store_report(pages: DataFrame, visited: DataFrame) -> DataFrame:
    """One row ``(crawled, errors, discovered)``; here ``crawled`` counts error pages too."""
    stored = pages.agg(F.count(F.lit(1)).alias("crawled"), F.count_if(F.col("error").isNotNull()).alias("errors"))
    known = visited.agg(F.count(F.lit(1)).alias("discovered"))
    return stored.crossJoin(known)  # one row each


def run_counters(visited: DataFrame, pages: DataFrame) -> DataFrame:
    """Counters per depth, and in total where ``depth`` is null; here ``crawled_pages`` excludes errors."""
    found = visited.groupBy("depth").agg(F.count(F.lit(1)).alias("discovered_urls"))
    fetched = pages.groupBy("depth").agg(
        F.count_if(F.col("error").isNull()).alias("crawled_pages"),
        F.count_if(F.col("error").isNotNull()).alias("error_pages"),
    )
    names = ("crawled_pages", "error_pages", "discovered_urls")
    per_depth = found.join(fetched, "depth", "full_outer").select(
        "depth", *[F.coalesce(name, F.lit(0)).alias(name) for name in names]
    )
    return per_depth.rollup("depth").agg(*[F.sum(name).alias(name) for name in names])


def distinct_hosts(urls: DataFrame, column: str = "url") -> DataFrame:
    return urls.select(host_key(F.col(column)).alias("host_key")).distinct()


def frontier_size(discovered: DataFrame, processed: DataFrame) -> DataFrame:
    """One row: how many discovered urls are not processed yet."""
    left = discovered.select("url").join(processed.select("url"), "url", "left_anti")
    return left.agg(F.count(F.lit(1)).alias("frontier_size"))
