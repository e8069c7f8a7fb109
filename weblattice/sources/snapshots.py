"""Versioned table folders: a version counts once its success marker is there, readers take the newest.

Writers never touch a version that readers may use, so a search beside a running job sees whole pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def folders(spark: SparkSession, marker: str) -> list[str]:
    """Names of the folders that hold a marker file, by a path pattern."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(marker)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return [status.getPath().getParent().getName() for status in found]


def versions(spark: SparkSession, root: str, prefix: str = "version") -> list[int]:
    """Numbers of the complete versions under ``root``, ascending."""
    return sorted(int(name.split("=")[1]) for name in folders(spark, f"{root}/{prefix}=*/_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_once(df: DataFrame, path: str, *by: str) -> None:
    """Write a folder (in folders of the columns ``by``), unless it is complete already: a replayed batch has the same rows, and readers may be using it."""
    marker = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).exists(marker):
        df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_version(df: DataFrame, root: str, version: int | None = None) -> int:
    """Write the next version, or a given one: a replayed batch leaves its complete output as it is."""
    if version is None:
        version = max(versions(df.sparkSession, root), default=-1) + 1
    write_once(df, f"{root}/version={version}")
    return version


def read_latest(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The newest complete version; no version reads as empty."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/version={known[-1]}")
