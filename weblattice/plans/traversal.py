"""Bounded breadth-first traversal, one join per level.

Every level is written to the shared folder. That ends its lineage, survives lost executors, and gives
the planner the true size of the frontier: a small one is broadcast, a large one shuffled to the buckets in which the edges lie. Edges lie sorted
by source, so a level opens only the pages of their files that its range of urls falls into.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from weblattice import schemas
from weblattice.operators.visited import add_visited
from weblattice.runtime import materialize, new_folder
from weblattice.sources.responses import seed_tasks
from weblattice.sources.visited_store import VisitedStore

_LEVEL = "url string, seed_ord bigint, depth int"

# A source with fewer links than this is never split.
HEAVY_LINKS = 100_000
# Sources are counted by hash first, and one by one only where a slot has enough links for a heavy one.
SLOTS = 1 << 16


@dataclass(frozen=True)
class EdgeStore:
    """Links shuffled once, for any number of levels and runs: a join on the source needs no exchange of them."""

    links: DataFrame  # (src, salt, dst), bucketed and sorted by source, and by salt if any source is heavy
    heavy: DataFrame | None  # (src, parts): sources whose links lie in several buckets; at most as many as there are buckets
    name: str  # of the table in the session's catalog

    def drop(self) -> None:
        """Take the table out of the catalog. Its files are in the shared folder and stay for queries that have begun."""
        self.links.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def store_edges(edges: DataFrame) -> EdgeStore:
    """Write ``edges (src, dst)`` in as many buckets as there are shuffle partitions.

    A bucket cannot be split later, so a source with more links than a bucket should hold is salted: its links are dealt over parts by their target, and a
    small table says how many. Sources without links, null ones, join with nothing and are left out.
    """
    spark = edges.sparkSession
    root, buckets = new_folder(spark, "edges"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = materialize(edges.select("src", "dst").where("src IS NOT NULL"), f"{root}/plain")
    most, heavy = max(HEAVY_LINKS, -(-plain.count() // buckets)), None
    salt = F.lit(0)
    if plain.count() > most:
        slotted = plain.select("src", F.pmod(F.xxhash64("src"), F.lit(SLOTS)).cast("int").alias("slot"))
        crowded = materialize(slotted.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("slot"), f"{root}/slots")
        counted = slotted.join(F.broadcast(crowded), "slot").groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)  # as few slots as buckets
        found = None if crowded.isEmpty() else materialize(counted.select("src", F.ceil(F.col("n") / most).cast("int").alias("parts")), f"{root}/heavy")
        if found is not None and not found.isEmpty():
            heavy = found
            plain = plain.join(F.broadcast(heavy), "src", "left")  # fewer rows than buckets: each has more than a bucket's share
            salt = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("dst"), F.col("parts"))).cast("int")
    # A salt that is always 0 would be planned away from the join, and then buckets by source and salt don't fit it.
    by = ("src",) if heavy is None else ("src", "salt")
    name = f"weblattice_edges_{uuid.uuid4().hex}"
    (
        plain.select("src", salt.alias("salt"), "dst").repartition(buckets, *by)
        .write.bucketBy(buckets, *by).sortBy(*by).option("path", f"{root}/buckets").saveAsTable(name, format="parquet")
    )
    return EdgeStore(spark.table(name), heavy, name)


@dataclass(frozen=True)
class Traversal:
    visited: DataFrame  # (url, origin_url, depth) discovered by this run; resumed tasks are older
    processed: DataFrame  # (url, origin_url, depth) whose pages this run takes
    frontier: DataFrame  # (url, origin_url, depth, seed_ord) pending: known but not processed


def traverse(
    edges: DataFrame | EdgeStore,
    max_depth: int,
    seeds: DataFrame | None = None,
    *,
    visited: DataFrame | VisitedStore | None = None,
    frontier: DataFrame | None = None,
    levels: int | None = None,
) -> Traversal:
    """Urls within ``max_depth`` hops of the seeds, each at its smallest depth.

    ``edges (src, dst)`` are the links of pages that may be expanded. ``visited`` holds urls of earlier
    runs, which are not entered again; of a ``VisitedStore`` a level reads only the pieces that its targets may be in. A non-empty ``frontier`` (a loaded checkpoint) replaces the seeds;
    its tasks beyond ``max_depth`` are left out. ``levels`` stops after that many levels were processed.
    A url that several seeds reach at one depth belongs to the first seed. ``edges`` may be stored already (``store_edges``),
    as for several runs over the same links.
    """
    if max_depth < 0:
        raise ValueError("max_depth must not be negative")
    store = edges if isinstance(edges, EdgeStore) else store_edges(edges)
    spark = store.links.sparkSession
    root = new_folder(spark, "traversal")
    resumed = frontier is not None and not frontier.isEmpty()
    if resumed:
        tasks = frontier.filter(F.col("depth") <= max_depth)
        if "seed_ord" not in tasks.columns:
            # Number the origins by name. Written out, as a recomputed sort could number them anew.
            names = tasks.select("origin_url").distinct().orderBy("origin_url")
            numbered = names.withColumn("seed_ord", F.monotonically_increasing_id())
            tasks = tasks.join(materialize(numbered, f"{root}/origins"), "origin_url")
    else:
        tasks = seed_tasks(seeds, max_depth)
        if isinstance(visited, VisitedStore):
            tasks = visited.unknown(materialize(tasks, f"{root}/seed-tasks"))
        elif visited is not None:
            tasks = tasks.join(visited.select("url"), "url", "left_anti")
    start = materialize(
        tasks.select("url", "origin_url", "depth", F.col("seed_ord").cast("bigint").alias("seed_ord")), f"{root}/start"
    )
    first, last = start.agg(F.min("depth"), F.max("depth")).first()

    levels_found: list[int] = []
    span = {r["depth"]: (r["lo"], r["hi"]) for r in start.groupBy("depth").agg(F.min("url").alias("lo"), F.max("url").alias("hi")).collect()}  # a row for each depth

    def at(depth: int) -> DataFrame:
        parts = [start.filter(F.col("depth") == depth).select("url", "seed_ord")] if depth <= last else []
        if depth in levels_found:
            parts.append(spark.read.schema(_LEVEL).parquet(f"{root}/level-{depth}").select("url", "seed_ord"))
        return reduce(DataFrame.unionByName, parts)

    def seen(schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/start", *[f"{root}/level-{depth}" for depth in levels_found])

    next_depth = first
    while next_depth is not None and next_depth <= max_depth and (levels is None or next_depth < first + levels):
        if next_depth < max_depth and (next_depth <= last or next_depth in levels_found):
            known = seen("url string")
            if isinstance(visited, DataFrame):
                known = known.unionByName(visited.select("url"))
            size, targets = Observation(), _expand(at(next_depth), store, known, span[next_depth])
            if isinstance(visited, VisitedStore):
                targets = visited.unknown(materialize(targets, f"{root}/targets-{next_depth + 1}"))
            targets.withColumn("depth", F.lit(next_depth + 1)).observe(
                size, F.count(F.lit(1)).alias("n"), F.min("url").alias("lo"), F.max("url").alias("hi")
            ).write.parquet(f"{root}/level-{next_depth + 1}")
            if size.get["n"]:
                levels_found.append(next_depth + 1)
                span[next_depth + 1] = _hull(span.get(next_depth + 1), (size.get["lo"], size.get["hi"]))
            elif next_depth >= last:
                next_depth = max_depth  # nothing left anywhere
        next_depth += 1

    if store is not edges:
        store.drop()
    origins = materialize(start.select("seed_ord", "origin_url").distinct(), f"{root}/seeds")
    tasks = seen(_LEVEL).join(origins, "seed_ord").select("url", "origin_url", "depth", "seed_ord")
    discovered = tasks.join(start.select("url"), "url", "left_anti") if resumed else tasks
    done_below = max_depth + 1 if next_depth is None else next_depth
    columns = ("url", "origin_url", "depth")
    return Traversal(
        visited=discovered.select(*columns),
        processed=tasks.filter(F.col("depth") < done_below).select(*columns),
        frontier=tasks.filter(F.col("depth") >= done_below),
    )


Span = tuple[str | None, str | None]


def _hull(one: Span | None, other: Span) -> Span:
    """The smallest range with both; null urls have none and join with nothing."""
    ends = [url for span in (one, other) if span is not None for url in span if url is not None]
    return (min(ends, key=str.encode), max(ends, key=str.encode)) if ends else (None, None)  # in the order of Spark and of Parquet's statistics


def _steps(current: DataFrame, store: EdgeStore, span: Span = (None, None)) -> DataFrame:
    """``(url, seed_ord)`` of every link that leaves the current level. A heavy source is asked for in each of its parts.

    ``span`` is the first and last url of the level, if known.
    """
    links = store.links if span[0] is None else store.links.where(F.col("src").between(*map(F.lit, span)))
    if store.heavy is None:
        return current.join(links, current["url"] == links["src"]).select(F.col("dst").alias("url"), "seed_ord")
    parts = F.broadcast(store.heavy.withColumnRenamed("src", "url"))
    tasks = current.join(parts, "url", "left").select("url", "seed_ord", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("_salt"))
    return tasks.join(links, (tasks["url"] == links["src"]) & (tasks["_salt"] == links["salt"])).select(F.col("dst").alias("url"), "seed_ord")


def _expand(current: DataFrame, store: EdgeStore, known: DataFrame, span: Span = (None, None)) -> DataFrame:
    """Targets of the current level that are not known yet, once each, with their first seed.

    The minimum is pre-aggregated in the map tasks, so a target that very many pages link to sends one
    row per task.
    """
    steps = _steps(current, store, span)
    return steps.groupBy("url").agg(F.min("seed_ord").alias("seed_ord")).join(known, "url", "left_anti")


def traverse_in_turn(edges: DataFrame, max_depth: int, seeds: list[DataFrame], visited: DataFrame | None = None) -> Traversal:
    """One run after another over a common visited set: the earlier run owns a shared url."""
    spark, runs = edges.sparkSession, []
    store = store_edges(edges)
    none = spark.createDataFrame([], schemas.VISITED)
    known = VisitedStore(spark, new_folder(spark, "visited"), ())
    if visited is not None:
        known = known.add(add_visited(none, visited), -1)
    for number, run_seeds in enumerate(seeds):
        run = traverse(store, max_depth, run_seeds, visited=known)
        runs.append(run)
        if number + 1 < len(seeds):
            known = known.add(add_visited(none, run.visited), number)
    store.drop()
    return Traversal(
        visited=reduce(DataFrame.unionByName, [run.visited for run in runs]),
        processed=reduce(DataFrame.unionByName, [run.processed for run in runs]),
        frontier=reduce(DataFrame.unionByName, [run.frontier for run in runs]),
    )
