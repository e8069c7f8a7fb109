"""Captured responses and seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weblattice import schemas
from weblattice.functions.content import decode_body
from weblattice.functions.urls import normalize_url


def read_responses(spark: SparkSession, path: str, schema: str = schemas.RESPONSES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_responses(spark: SparkSession, path: str, schema: str = schemas.RESPONSES, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def decode_responses(responses: DataFrame) -> DataFrame:
    """Binary bodies to text. An unknown charset turns the response into an error with status 0."""
    decoded = responses.withColumn("_text", decode_body(F.col("body"), F.col("content_type")))
    failed = F.col("_text.error").isNotNull()
    return decoded.withColumns({
        "body": F.col("_text.text"),
        "status_code": F.when(failed, 0).otherwise(F.col("status_code")),
        "error": F.coalesce("_text.error", "error"),
    }).drop("_text")


def seed_tasks(seeds: DataFrame, max_depth: int) -> DataFrame:
    """Seeds ``(seed_ord, url)`` as depth-0 tasks, each its own origin; the first of equal urls stays."""
    if max_depth < 0:
        raise ValueError("max_depth must not be negative")
    url = normalize_url(F.col("url"))
    return (
        seeds.groupBy(url.alias("url")).agg(F.min("seed_ord").alias("seed_ord"))
        .select("url", F.col("url").alias("origin_url"), F.lit(0).alias("depth"), "seed_ord")
    )


def seeds_from(spark: SparkSession, *urls: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(urls)), schemas.SEEDS)
