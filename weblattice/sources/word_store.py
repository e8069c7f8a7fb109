"""Word posting store: the text form ``word url origin depth frequency`` and a parquet twin for reading at scale."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weblattice import schemas
from weblattice.functions.urls import strip
from weblattice.operators.postings import POSTING_COLUMNS, keep_valid


def append_posting_lines(postings: DataFrame, path: str) -> int:
    """Append one line per posting and return how many were written."""
    written = Observation()
    lines = keep_valid(postings).select(F.concat_ws(" ", *POSTING_COLUMNS).alias("value"))
    lines.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").text(path)
    return written.get["n"]


def read_posting_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with exactly five fields and two integers; others are dropped. No file reads as empty.

    A url that holds white space makes a line of more than five fields and is lost here; the parquet
    twin keeps it.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.WORD_POSTINGS)
    return parse_posting_lines(lines)


def parse_posting_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    fields = F.split(strip(F.col(column)), r"(?U)[\s\x1c-\x1f]+")
    return (
        lines.select(fields.alias("_f")).filter(F.size("_f") == 5)
        .select(
            F.col("_f")[0].alias("word"), F.col("_f")[1].alias("url"), F.col("_f")[2].alias("origin_url"),
            F.col("_f")[3].try_cast("int").alias("depth"), F.col("_f")[4].try_cast("int").alias("frequency"),
        )
        .filter(F.col("depth").isNotNull() & F.col("frequency").isNotNull())
    )


def by_word(postings: DataFrame) -> DataFrame:
    """Valid postings in files by word, sorted, so that a word filter skips row groups.

    The rebalance hint has adaptive execution cut the partition of a word that is on most pages into
    files of normal size.
    """
    return keep_valid(postings).hint("rebalance", "word").sortWithinPartitions("word", "url")


def write_postings(postings: DataFrame, path: str, mode: str = "append") -> None:
    by_word(postings).write.mode(mode).parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WORD_POSTINGS).parquet(path)
