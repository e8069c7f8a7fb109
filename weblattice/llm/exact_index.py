"""Exact dedup on a persistent digest index: bucketed and sorted by digest, probed by a sort-merge anti-join, then appended.

Later batches append the digests that the index does not hold. What they bring of known texts (their number and smallest id) is kept beside the table and
summed up when entries are read, so ``keep_id`` and ``group_size`` are those of all batches; a later batch with a smaller id moves ``keep_id``. An append is
not to be repeated: after one that was cut short, build the index again.

Texts are equal when they are identical after each run of ASCII white space is replaced by one space. A null text counts as
empty; empty texts are equal to each other. Rows that repeat a ``doc_id`` are the same document and are kept or dropped together
by ``membership``. A null ``doc_id`` never becomes the keeper of a group that has another id. Other columns play no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common
from weblattice.sources.snapshots import folders, remove

#: Rows of the index: one per distinct text.
ENTRY = "digest binary, keep_id bigint, group_size bigint"

#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def digest(text: Column | str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8."""
    return F.unhex(F.sha2(F.regexp_replace(common.whole_text(text), common.WHITE, " ").cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest)`` of every row."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest().alias("digest"))


def create_index(spark: SparkSession, name: str, buckets: int, path: str | None = None) -> None:
    """An empty index, as a table bucketed and sorted by digest, with its files at ``path`` (by default in the shared folder)."""
    location = path or runtime.new_folder(spark, "exact-index")
    _bucketed(spark.createDataFrame([], ENTRY), buckets, "errorifexists").option("path", location).saveAsTable(name)


def _bucketed(entries: DataFrame, buckets: int, mode: str):
    return entries.repartition(buckets, "digest").write.mode(mode).format("parquet").bucketBy(buckets, "digest").sortBy("digest")


def _described(spark: SparkSession, name: str, what: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what).head()["data_type"]


def location_of(spark: SparkSession, name: str) -> str:
    return _described(spark, name, "Location")


def append(name: str, found: DataFrame) -> None:
    """Add what ``(doc_id, digest)`` rows bring.

    Groups are summed up before the shuffle, so a text of a third of all rows is a few rows. Both sides of the anti-join are then
    unique in the digest, and the index side is read by bucket and in order, without a shuffle.
    """
    spark = found.sparkSession
    entries = common.written(found.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "exact-entries")
    index = spark.table(name).select("digest").hint("merge")
    # The joins read the table that is appended to: end their plans first.
    new = common.written(entries.join(index, "digest", "left_anti"), "exact-new")
    known = common.written(entries.join(index, "digest", "left_semi"), "exact-known")
    if not known.isEmpty():
        known.write.parquet(f"{location_of(spark, name)}-known/{uuid.uuid4().hex}")
    _bucketed(new, int(_described(spark, name, "Num Buckets")), "append").saveAsTable(name)


def entries_of(spark: SparkSession, name: str) -> DataFrame:
    """The entries of all batches, from plain files: joins with them may be split by adaptive execution at a hot digest."""
    location = location_of(spark, name)
    entries = spark.read.schema(ENTRY).parquet(location)
    later = folders(spark, f"{location}-known/*/_SUCCESS")
    if not later:
        return entries
    more = spark.read.schema(ENTRY).parquet(*[f"{location}-known/{part}" for part in later])
    return entries.unionByName(more).groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def drop_index(spark: SparkSession, name: str) -> None:
    """Remove the table and its files."""
    location = location_of(spark, name)
    spark.sql(f"DROP TABLE {name}")
    for path in (location, f"{location}-known"):
        remove(spark, path)


def membership(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row with the entry of its text: ``doc_id, keep_id, group_size, kept, digest``."""
    return found.join(entries, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows whose text no row with a smaller ``doc_id`` has, with all their columns; of rows that repeat such an id, one.

    The rows are one batch for an index of their own, which is dropped when its entries are read.
    """
    spark, name = docs.sparkSession, f"exact_{uuid.uuid4().hex}"
    create_index(spark, name, common.partitions(spark))
    append(name, digests(docs))
    key = F.coalesce(F.col("keep_id"), F.lit(NO_ID))
    kept = common.written(entries_of(spark, name).select(F.col("digest").alias("__digest"), key.alias("__id")), "exact-kept")
    drop_index(spark, name)
    # Both steps need the rows by the same two columns: the texts are shuffled once.
    with_key = docs.withColumn("__digest", digest()).withColumn("__id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)))
    return with_key.join(kept.hint("shuffle_hash"), ["__digest", "__id"], "left_semi").dropDuplicates(["__digest", "__id"]).select(*docs.columns)
