"""Result shapes of the two searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weblattice.operators.word_search import result_order
from weblattice.runtime import materialize, new_folder

PAGE_SIZE = 100


def numbered(results: DataFrame, sort_by: str = "relevance") -> DataFrame:
    """``results`` with ``position``, counted from 1 in the order of the mode.

    The sorted rows are written out by range, so the files follow each other; a place is the row's number in its file
    and the rows of the files before. Only the counts of the files are summed up in one task.
    """
    ordered = materialize(results.orderBy(*result_order(sort_by)), new_folder(results.sparkSession, "search-results"))
    file_no = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint")
    rows = ordered.select("*", file_no.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").select(*results.columns, (F.col("_start") + F.col("_row") + 1).alias("position"))


def search_response(
    results: DataFrame, query: str, sort_by: str = "relevance", limit: int | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Pages ``(query, page_no, response)`` that together hold all results, or the first ``limit``.

    ``response`` is ``{query, results: [{url, score, frequency, depth}]}``. A row has at most ``page_size`` results, however
    many there are; no result at all is one page without results.
    """
    rows = numbered(results, sort_by)
    if limit is not None:
        rows = rows.filter(F.col("position") <= limit)
    item = F.struct("position", F.struct("url", "score", "frequency", "depth").alias("row"))
    pages = rows.groupBy(F.floor((F.col("position") - 1) / page_size).alias("page_no")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    # One page number more, which only shows if there is no other.
    first = results.sparkSession.range(1).select(F.col("id").alias("page_no"))
    listed = first.join(pages, "page_no", "full_outer")
    found = F.coalesce(F.transform("items", lambda x: x["row"]), F.array().cast(
        "array<struct<url:string,score:int,frequency:int,depth:int>>"))
    return listed.select(
        F.lit(query).alias("query"), "page_no", F.to_json(F.struct(F.lit(query).alias("query"), found.alias("results"))).alias("response"))


def text_results(ranked: DataFrame) -> DataFrame:
    """``(url, origin_url, depth)`` in rank order."""
    return ranked.orderBy("rank", "url").select("url", "origin_url", "depth")
