"""Inputs that the registered queries derive from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from weblattice.functions.urls import host_key, normalize_url, site_root
from weblattice.operators.extraction import extract_pages
from weblattice.runtime import materialize, new_folder

HTML_TYPE = "text/html; charset=utf-8"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that comes in one small file; a large table has enough splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.sparkSession.sparkContext.master.startswith("local") else df


def as_responses(pages: DataFrame) -> DataFrame:
    """Raw pages as captured responses with the status, error and type rules of the fixtures."""
    kind = F.col("page_id") % 10
    url = normalize_url(F.col("url"))
    return pages.select(
        url.alias("url"), site_root(url).alias("origin_url"), (F.col("page_id") % 4).cast("int").alias("depth"),
        F.when(kind == 7, 404).when(kind == 9, 0).otherwise(200).alias("status_code"),
        F.when(kind == 8, "text/plain").otherwise(HTML_TYPE).alias("content_type"),
        F.col("html").alias("body"),
        F.when(kind == 7, "HTTPError: Not Found").when(kind == 9, "timed out").alias("error"),
    )


def as_good_pages(pages: DataFrame) -> DataFrame:
    """All raw pages as successful HTML responses."""
    return as_responses(pages).withColumns({
        "status_code": F.lit(200), "content_type": F.lit(HTML_TYPE), "error": F.lit(None).cast("string"),
    })


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_responses(spread(table(spark, sf_dir, "pages")))


def good_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(url, origin_url, depth, title, content, links, ...)`` with every page parsed as HTML."""
    return extract_pages(as_good_pages(spread(table(spark, sf_dir, "pages"))))


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written out: for jobs that read the pages more than once."""
    return materialize(good_pages(spark, sf_dir), new_folder(spark, "pages"))


def text_documents(spark: SparkSession, sf_dir: str, spread_out: bool = True) -> DataFrame:
    """The ``documents`` table as pages with an empty title; not spread out for a job that deals its pages itself."""
    url = F.concat(F.lit("doc://"), F.col("doc_id").cast("string"))
    documents = table(spark, sf_dir, "documents")
    return (spread(documents) if spread_out else documents).select(
        url.alias("url"), F.concat(F.lit("src://"), F.col("source")).alias("origin_url"),
        (F.col("doc_id") % 4).cast("int").alias("depth"), F.lit("").alias("title"), F.col("text").alias("content"),
    )


def key_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys as links: nation -> customer -> order -> part -> supplier -> nation."""
    def node(prefix: str, key: str):
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    lineitem = table(spark, sf_dir, "lineitem")
    steps = [
        (table(spark, sf_dir, "customer"), node("n:", "c_nationkey"), node("c:", "c_custkey")),
        (table(spark, sf_dir, "orders"), node("c:", "o_custkey"), node("o:", "o_orderkey")),
        (lineitem, node("o:", "l_orderkey"), node("p:", "l_partkey")),
        (lineitem, node("p:", "l_partkey"), node("s:", "l_suppkey")),
        (table(spark, sf_dir, "supplier"), node("s:", "s_suppkey"), node("n:", "s_nationkey")),
    ]
    return reduce(DataFrame.unionByName, [df.select(src.alias("src"), dst.alias("dst")) for df, src, dst in steps])


def graph_seeds(spark: SparkSession, sf_dir: str, *keys: int) -> DataFrame:
    """Nations as seeds, in key order."""
    return table(spark, sf_dir, "nation").filter(F.col("n_nationkey").isin(*keys)).select(
        F.col("n_nationkey").cast("bigint").alias("seed_ord"),
        F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")).alias("url"),
    )


def robots_files(pages: DataFrame) -> DataFrame:
    """One robots.txt per host of the pages, built from its host name: other agents, blank lines,
    comments, escapes, a later ``Allow`` that a first match hides, and hosts that answer 404."""
    hosts = pages.select(host_key(F.col("url")).alias("host_key")).distinct()
    size = F.length("host_key")
    body = F.concat(
        F.lit("# robots\nUser-agent: otherbot\nDisallow: /\n\n"),
        F.when(size % 3 == 0, F.lit("User-agent: LatticeBot\nDisallow: /fr/\nAllow: /fr/1\n\nUser-agent: *\nDisallow: /\n"))
        .when(size % 3 == 1, F.lit("User-agent: *\nAllow: /en/1\nDisallow: /en # all but 1\nDisallow: /%65s/\nDisallow: /*?page\n"))
        .otherwise(F.lit("User-agent: *\nCrawl-delay: 2\nDisallow:\nDisallow: /de/\n")),
    )
    status = F.when(size % 7 == 0, 404).otherwise(200)
    return hosts.select("host_key", status.alias("status_code"), body.alias("body"))


def page_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw page url as a seed, in page order."""
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("bigint").alias("seed_ord"), "url")


def _with_stride(pages: DataFrame) -> DataFrame:
    """Add ``stride``: a multiple of ten that cuts the pages into about six equal runs."""
    size = pages.agg((F.ceil(F.count(F.lit(1)) / 60) * 10).alias("stride"))
    return pages.crossJoin(F.broadcast(size))  # one row


def linked_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured pages, each with a link to the page one stride further appended.

    The pages' own links lead nowhere inside the corpus; these chains give a crawl some depth.
    """
    pages = _with_stride(table(spark, sf_dir, "pages"))
    following = pages.select((F.col("page_id") - F.col("stride")).alias("page_id"), F.col("url").alias("_next"))
    link = F.when(
        F.col("_next").isNotNull(), F.concat(F.lit('<p><a href="'), F.col("_next"), F.lit('">next</a></p>'))
    ).otherwise("")
    chained = spread(pages.join(following, "page_id", "left")).withColumn("html", F.concat("html", link))
    return as_responses(chained)


def chain_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of every chain."""
    heads = _with_stride(table(spark, sf_dir, "pages")).filter(F.col("page_id") < F.col("stride"))
    return heads.select(F.col("page_id").cast("bigint").alias("seed_ord"), "url")
