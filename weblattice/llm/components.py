"""Connected components of a link table, by alternating large-star and small-star steps over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblattice.llm import common


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links(a, b)``; the root is the smallest node of its component.

    A step sends links to the smallest neighbour: the minimum is taken in map tasks first, and the join back is plain, so a
    node with many links is split. Each round is a written table, and rounds end when nothing changes.
    """
    edges = common.written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = common.written(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = common.written(small.where("u <> v").distinct(), "small-star")
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).head()
        if now == mark:
            break
        mark = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
