"""Word search: exact match on one word, scored by frequency and depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weblattice.functions.scoring import word_score
from weblattice.functions.words import normalize_query
from weblattice.runtime import materialize, new_folder

RESULT_COLUMNS = ("url", "score", "frequency", "depth")


def sort_keys(sort_by: str) -> list[Column]:
    """Ascending sort keys of a mode; an unknown mode means relevance. Ties go by url, then frequency."""
    leading = {"frequency": -F.col("frequency"), "depth": F.col("depth")}
    return [leading.get(sort_by, -F.col("score")), F.col("url"), -F.col("frequency"), F.col("depth")]


def result_order(sort_by: str) -> list[Column]:
    return [key.asc() for key in sort_keys(sort_by)]


def scored(postings: DataFrame) -> DataFrame:
    return postings.withColumn("score", word_score(F.col("frequency"), F.col("depth")))


def search_words(postings: DataFrame, query: str, sort_by: str = "relevance", limit: int | None = None) -> DataFrame:
    """All postings of the query word, best first. Blank text, or text with a blank inside, finds none."""
    word = query.strip().lower()
    found = scored(postings.filter(F.col("word") == F.lit(word)) if word else postings.filter(F.lit(False)))
    ordered = found.select(*RESULT_COLUMNS).orderBy(*result_order(sort_by))
    return ordered if limit is None else ordered.limit(limit)


def _of_words(postings: DataFrame, words: DataFrame) -> DataFrame:
    """The postings of the words, written out.

    The join is the last step of its job, so the planner may broadcast few words, and adaptive execution may split
    a hot word between tasks where there are many.
    """
    return materialize(postings.join(words, "word", "left_semi"), new_folder(postings.sparkSession, "word-postings"))


def search_words_batch(postings: DataFrame, queries: DataFrame, limit: int | None = 25, sort_by: str = "relevance") -> DataFrame:
    """Top results for a table ``(query_id, query)``: ``(query_id, query, position, url, score, ...)``.

    Each distinct word is ranked once. The row_number filter lets Spark cut every map partition to the
    best ``limit`` rows per word before the shuffle, so a hot word sends few rows to its task. The
    queries join the ranked lists, never the postings; the lists are written out, so that join is a
    broadcast if they are small and can be split at a word that very many queries ask for.

    Without a limit all postings are returned; they are not numbered then (``position`` is null), as that would take all of
    a word to one task.
    """
    spark = postings.sparkSession
    asked = queries.withColumn("word", normalize_query(F.col("query"))).filter(F.col("word") != "")
    words = materialize(asked.select("word").distinct(), new_folder(spark, "query-words"))
    found = scored(_of_words(postings, words)).select("word", *RESULT_COLUMNS)
    if limit is None:
        return asked.join(found, "word").select("query_id", "query", F.lit(None).cast("int").alias("position"), *RESULT_COLUMNS)
    best_first = Window.partitionBy("word").orderBy(*result_order(sort_by))
    top = found.withColumn("position", F.row_number().over(best_first)).filter(F.col("position") <= limit)
    top = materialize(top, new_folder(spark, "ranked-words"))
    return asked.join(top, "word").select("query_id", "query", "position", *RESULT_COLUMNS)


def audit_scores(postings: DataFrame, results: DataFrame, top: int = 3, words: DataFrame | None = None) -> DataFrame:
    """Compare search output with the formula, for the ``top`` postings of each word (of ``words``, if given).

    ``results`` is ``(word, position, url, score, frequency, depth)``. Checked are the score, the sort
    order and that all fields are there; a row missing on either side fails.
    """
    by_formula = F.col("frequency") * 10 + 1000 - F.col("depth") * 5
    order = Window.partitionBy("word").orderBy(F.desc("manual_score"), "url", F.desc("frequency"))
    # Few words are wanted as a rule: take their postings before any is ranked.
    wanted = postings if words is None else _of_words(postings, words.select("word").distinct())
    manual = (
        wanted.select("word", "url", "frequency", by_formula.alias("manual_score"))
        .withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)
        .select("word", "position", F.col("url").alias("manual_url"), "manual_score")
    )
    reported = results.filter(F.col("position") <= top)
    joined = manual.join(reported, ["word", "position"], "full_outer")
    complete = F.col("frequency").isNotNull() & F.col("depth").isNotNull() & F.col("url").isNotNull()
    checks = {
        "score_ok": F.coalesce(F.col("score") == F.col("manual_score"), F.lit(False)),
        "order_ok": F.coalesce(F.col("url") == F.col("manual_url"), F.lit(False)),
        "fields_ok": complete,
    }
    return joined.withColumns(checks).withColumn("passed", F.expr("score_ok AND order_ok AND fields_ok")).select(
        "word", "position", "manual_url", "manual_score", "url", "score", *checks, "passed"
    )
