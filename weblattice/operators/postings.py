"""Word index: one posting per word of a page, ``(word, url, origin_url, depth, frequency)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weblattice.functions.words import index_words, repeat_runs, run_length, run_token

POSTING_COLUMNS = ("word", "url", "origin_url", "depth", "frequency")


def word_postings(pages: DataFrame) -> DataFrame:
    """Count the words of each page; error pages, if marked, give none.

    The count happens inside the row, so the build is a map-only job: a page fetched many times, or a
    word found everywhere, needs no shuffle and cannot become a hot key. Each page row gives its own
    postings, as repeated crawls append theirs.
    """
    if "error" in pages.columns:
        pages = pages.filter(F.col("error").isNull())
    runs = pages.select(
        "url", "origin_url", "depth", F.explode(repeat_runs(index_words(F.col("content")))).alias("_run")
    ).withColumn("word", run_token(F.col("_run")))
    return runs.select(
        "word", "url", "origin_url", "depth", run_length(F.col("_run"), F.col("word")).alias("frequency")
    )


def keep_valid(postings: DataFrame) -> DataFrame:
    """Drop postings with an empty word or without occurrences."""
    return postings.filter((F.col("word") != "") & (F.col("frequency") > 0))


def words_on_many_urls(postings: DataFrame, min_urls: int = 2) -> DataFrame:
    """Words found on at least ``min_urls`` different urls, with that number."""
    return (
        postings.groupBy("word").agg(F.count_distinct("url").alias("n_urls"))
        .filter(F.col("n_urls") >= min_urls)
    )


def append_postings(*batches: DataFrame) -> DataFrame:
    """Bag union of the postings of several pages or runs; nothing is deduplicated."""
    out = batches[0].select(*POSTING_COLUMNS)
    for batch in batches[1:]:
        out = out.unionByName(batch.select(*POSTING_COLUMNS))
    return out
