"""Frontier checkpoint: the tasks a stopped traversal has yet to process."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weblattice import schemas
from weblattice.sources.snapshots import read_latest, write_version


def save_frontier(frontier: DataFrame, root: str) -> int:
    """Replace the whole checkpoint by the pending tasks of a traversal and return their number."""
    saved = Observation()
    seed = F.col("seed_ord").cast("bigint").alias("seed_ord")
    rows = frontier.select("url", "origin_url", "depth", seed, F.current_timestamp().alias("saved_at"))
    write_version(rows.observe(saved, F.count(F.lit(1)).alias("n")), root)
    return saved.get["n"]


def clear_frontier(spark: SparkSession, root: str) -> None:
    save_frontier(spark.createDataFrame([], schemas.FRONTIER_CHECKPOINT).drop("saved_at"), root)


def load_frontier(spark: SparkSession, root: str) -> DataFrame:
    """The last saved tasks, oldest first; url breaks ties."""
    return read_latest(spark, root, schemas.FRONTIER_CHECKPOINT).orderBy("saved_at", "url")
