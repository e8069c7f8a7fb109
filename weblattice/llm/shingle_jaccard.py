"""Near-dedup by covering SimHash and the Jaccard similarity of word shingles: wide candidates, then the exact similarity before anything is linked.

A text is the set of the hashes of its runs of ``shingle`` words (lower case, split at ASCII white space); a shorter text is one run, and a
text without words is the empty set. Equal sets are one row. Candidates come from two sides. ``covering_simhash`` links the fingerprints of the texts, of the
same shingles with repeats, within its radius; its masks miss none of these. At 0.8 such fingerprints differ in ten places on average, beyond any radius that
masks cover at a bearable number of tables. So ``BANDS`` independent fingerprints of ``ROWS`` minima each add what lies further apart:
texts of similarity s share none of them with probability (1 - s^6)^48, which is 5e-7 at 0.8 and 1e-10 at 0.85.

Each bucket of minima and each fingerprint gives a star of candidate links, linear in its size. What these connect goes to one task with its sets, and there a breadth-first
search links what has a similarity of at least ``threshold``, by exact counts. So no bucket is cut, and no pair is linked on an estimate. A group of
candidates is not split further over tasks.

First only keys and buckets are written; sets are made again for one text of each key that shares a bucket. Stars, chosen texts and the rows to drop are
broadcast up to ``MOST_BROADCAST`` rows and shuffled beyond. What ``deduplicated`` has written goes when the rows to drop are written.

Rows that repeat a ``doc_id`` count one by one. A null text counts as empty. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common, covering_simhash
from weblattice.llm.components import components
from weblattice.sources.snapshots import remove

SHINGLE, THRESHOLD, SEED = 5, 0.8, 42
BANDS, ROWS = 48, 6
#: Rows of a few numbers each that are broadcast at most.
MOST_BROADCAST = 2_000_000
#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the word shingles, in order."""
    from xxhash import xxh64_intdigest

    words = text.lower().encode().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter((xxh64_intdigest(w, SEED) for w in words), dtype=np.uint64, count=len(words))
    length = min(shingle, len(words))
    count = len(words) - length + 1
    out = np.full(count, length, dtype=np.uint64)
    for i in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[i:i + count]
    return np.unique(mixed(out))


def multipliers() -> np.ndarray:
    return mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def bands(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One bucket for each band, as signed numbers; the empty set has none."""
    if not len(grams):
        return np.empty(0, dtype=np.int64)
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 512):
        np.minimum(least, (grams[at:at + 512, None] * factors).min(axis=0), out=least)
    rows = mixed(least).reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return out.view(np.int64)


class Tables:
    """Tables in the shared folder that can be deleted together."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folders = spark, []

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        self.folders.append(runtime.new_folder(self.spark, f"jaccard-{purpose}"))
        return runtime.materialize(df, self.folders[-1])

    def drop(self) -> None:
        for folder in self.folders:
            remove(self.spark, folder)
        self.folders.clear()


def small_side(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows; adaptive execution can split the shuffled join of a larger one."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(common.whole_text()).alias("text_key"), common.whole_text().alias("text"))


def sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_key, set_key, bands, fp)`` of every row; equal sets have equal keys, fp is the SimHash of the text as a signed number."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        factors = multipliers()
        for batch in batches:
            keys, buckets, fps = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), shingle)
                fps.append(covering_simhash.signed(covering_simhash.fingerprint(text.as_py().lower().encode(), shingle)))
                keys.append(xxh64_intdigest(found.astype("<u8").tobytes(), SEED))
                buckets.append(bands(found, factors))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(keys, dtype=np.uint64).view(np.int64), pa.int64()), pa.array(buckets, pa.list_(pa.int64())),
                 pa.array(fps, pa.int64())],
                names=["doc_id", "text_key", "set_key", "bands", "fp"])

    return keyed(docs).mapInArrow(work, "doc_id bigint, text_key bigint, set_key bigint, bands array<bigint>, fp bigint")


def members_of(docs: DataFrame, chosen: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(root, set_key, grams)`` of the texts in ``chosen(id, text_key, set_key, root)``, each set once."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [shingles(text.as_py(), shingle).astype("<u8").tobytes() for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(grams, pa.binary())], names=["root", "set_key", "grams"])

    rows = keyed(docs).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).join(small_side(chosen), ["id", "text_key"])
    return rows.select("root", "set_key", "text").mapInArrow(work, "root bigint, set_key bigint, grams binary").dropDuplicates(["set_key"])


def similar_links(keys: list[int], grams: list[np.ndarray], threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Links that connect what has at least this similarity, by breadth-first search: each set is reached once."""
    sizes = np.array([len(g) for g in grams], dtype=np.int64)
    distinct, flat = np.unique(np.concatenate(grams), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    own = lambda i: flat[starts[i]:starts[i + 1]]
    marked = np.zeros(len(distinct), dtype=bool)
    waiting, ids = np.ones(len(keys), dtype=bool), np.arange(len(keys))
    held, at = flat, starts[:-1]
    links: list[tuple[int, int]] = []
    for first in range(len(keys)):
        if not waiting[first]:
            continue
        waiting[first] = False
        front = [first]
        while front:
            if 2 * np.count_nonzero(waiting[ids]) < len(ids):  # what is reached goes from the table
                ids = ids[waiting[ids]]
                held = np.concatenate([own(i) for i in ids]) if len(ids) else flat[:0]
                at = np.r_[0, np.cumsum(sizes[ids])][:-1]
            if not len(ids):
                break
            one = front.pop()
            marked[own(one)] = True
            both = np.add.reduceat(marked[held], at, dtype=np.int64)
            marked[own(one)] = False
            near = ids[waiting[ids] & (both >= threshold * (sizes[one] + sizes[ids] - both) - 1e-9)]
            waiting[near] = False
            links += [(keys[one], keys[i]) for i in near]
            front += near.tolist()
    return links


def exact_links(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links ``(a, b)`` inside the groups of ``members(root, set_key, grams)``; a set stands in one group, once."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: list[int], grams: list[np.ndarray]) -> pa.RecordBatch:
            found = similar_links(keys, grams, threshold) if len(keys) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        # A group may go on in the next batch: its rows wait.
        group, keys, grams = None, [], []
        for batch in batches:
            for root, key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if root != group and keys:
                    yield out(keys, grams)
                    keys, grams = [], []
                group = root
                keys.append(key)
                grams.append(np.frombuffer(raw.as_buffer().to_pybytes(), dtype="<u8"))
        yield out(keys, grams)

    dealt = members.select("root", "set_key", "grams").repartition(common.partitions(members.sparkSession), "root").sortWithinPartitions("root", "set_key")
    return dealt.mapInArrow(work, "a bigint, b bigint")


def candidate_links(found: DataFrame, tables: Tables) -> DataFrame:
    """A star of links ``(a, b)`` for each bucket of two or more sets."""
    buckets = found.select("set_key", F.explode("bands").alias("bucket"))
    # Minima are taken in map tasks first, and the join back is plain: adaptive execution can split a hot bucket.
    stars = buckets.groupBy("bucket").agg(F.min("set_key").alias("a"), F.max("set_key").alias("last")).where("a <> last").select("bucket", "a")
    stars = tables.written(stars, "stars")
    return buckets.join(small_side(stars), "bucket").where("set_key <> a").select("a", F.col("set_key").alias("b")).distinct()


def covering_links(found: DataFrame, tables: Tables) -> DataFrame:
    """Links ``(a, b)`` that connect all sets whose texts have fingerprints within the radius of ``covering_simhash``: a star for each
    fingerprint, and what its masks link of distinct fingerprints."""
    pairs = tables.written(found.select("set_key", "fp").distinct(), "fingerprints")
    firsts = tables.written(pairs.groupBy("fp").agg(F.min("set_key").alias("first"), F.max("set_key").alias("last")), "fingerprint-sets")
    shared = firsts.where("first <> last").select("fp", "first")
    stars = pairs.join(small_side(tables.written(shared, "fingerprint-stars")), "fp").where("set_key <> first").select(F.col("first").alias("a"), F.col("set_key").alias("b"))
    near = tables.written(covering_simhash.near_links(firsts.select("fp")), "fingerprint-links")
    for end in ("a", "b"):
        near = near.join(firsts.select(F.col("fp").alias(end), F.col("first").alias(f"_{end}")), end)
    return stars.unionByName(near.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b")).distinct()


def grouped(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, tables: Tables | None = None) -> DataFrame:
    """``(doc_id, text_key, component_id)`` of every row; the component is named by its smallest ``doc_id``."""
    runtime.bounded_batches(docs.sparkSession)
    tables = tables or Tables(docs.sparkSession)
    found = tables.written(sets(docs, shingle), "sets")
    loose = tables.written(components(tables.written(candidate_links(found, tables).unionByName(covering_links(found, tables)).distinct(), "candidates")), "loose")
    chosen = found.join(small_side(loose.withColumnRenamed("node", "set_key")), "set_key").groupBy("set_key", "root").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_key")).alias("one"))
    chosen = tables.written(chosen.select("set_key", "root", "one.id", "one.text_key"), "chosen")
    roots = components(tables.written(exact_links(members_of(docs, chosen, shingle), threshold), "links"))
    rooted = tables.written(
        found.groupBy("set_key").agg(F.min("doc_id").alias("first_id")).join(roots.withColumnRenamed("node", "set_key"), "set_key", "left").select(
            "set_key", "first_id", F.coalesce("root", "set_key").alias("root")), "roots")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = tables.written(rooted.join(names, "root").select("set_key", "component_id"), "components")
    return found.select("doc_id", "text_key", "set_key").join(named, "set_key").select("doc_id", "text_key", "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The first document of each component, with all columns. Rows that repeat its id stay if they are of that component."""
    tables = Tables(docs.sparkSession)
    gone = grouped(docs, shingle, threshold, tables).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("__gone"), F.col("text_key").alias("__key")).distinct()
    gone = common.written(gone, "jaccard-gone")
    tables.drop()  # what is returned reads the documents and the rows to drop only
    same = (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)) == F.col("__gone")) & (F.xxhash64(common.whole_text()) == F.col("__key"))
    return docs.join(small_side(gone), same, "left_anti")


runtime.ship_by_value(__name__)
