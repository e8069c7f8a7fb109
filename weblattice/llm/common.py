"""Inputs, shared tables and small helpers of the operators."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblattice import runtime

#: ASCII white space, and a word as the contracts define it.
WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends, and lost executors lose nothing."""
    return runtime.materialize(df, runtime.new_folder(df.sparkSession, purpose))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def hashed_sample(rows: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """At most ``size`` rows, always the same ones: those with the smallest hash of the key."""
    return rows.orderBy(F.xxhash64(key), key).limit(size)


def process_store(name: str) -> dict:
    """A dictionary that a Python worker keeps between its tasks, for tables that are costly to load."""
    return sys.__dict__.setdefault("_weblattice_store", {}).setdefault(name, {})


runtime.ship_by_value(__name__)
