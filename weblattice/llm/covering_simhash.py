"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint has 64 bits. Each bit place gets a non-zero vector of ``radius + 1`` bits, in turn; each non-zero vector v of that length is
a table, whose mask holds the places with an odd scalar product with v. Up to ``radius`` differing places span less than the whole space,
so some v is orthogonal to all of them: that table's mask misses every difference, and the pair collides there. No link can be missed.

Fingerprints are made distinct first, so copies are one row. A bucket of more than ``SMALL`` fingerprints is dealt once more by parts
of the places its mask leaves free: six parts, of which any three must agree for a pair in reach, so 20 finer buckets,
in which about 15 places are free. Those are bounded by the number of values of their free places. A bucket gives a
spanning forest of its links, never all pairs.

A null text has no words; texts without words have fingerprint zero and are linked like any others. Rows that repeat a ``doc_id``
are fingerprinted one by one and linked to their own component. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common
from weblattice.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Distinct fingerprints of a bucket that one task compares directly.
SMALL = 128
PARTS = 6


def masks(radius: int = RADIUS) -> list[int]:
    """One mask for each table, unsigned."""
    size = 1 << (radius + 1)
    vectors = [1 + place % (size - 1) for place in range(BITS)]
    return [sum(1 << p for p, x in enumerate(vectors) if bin(x & v).count("1") % 2) for v in range(1, size)]


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks over the places that a mask leaves free: any ``PARTS - radius`` of ``PARTS`` parts."""
    free = [p for p in range(BITS) if not mask >> p & 1]
    parts = [sum(1 << p for p in free[i::PARTS]) for i in range(PARTS)]
    return [sum(chosen) for chosen in combinations(parts, PARTS - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: majority bits of the hashes of its word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row; fp is the fingerprint as a signed number."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(fingerprint(x.as_buffer().to_pybytes(), shingle)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, fp bigint")


def forest(key: np.ndarray, fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is in reach of each other inside runs of an equal key; rows come in order of the key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.r_[starts[1:], len(key)]
    links: list[tuple[int, int]] = []
    pairs = starts[ends - starts == 2]
    near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= radius
    links += zip(fp[pairs][near].tolist(), fp[pairs + 1][near].tolist(), strict=True)
    for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
        own = fp[start:end]
        waiting = np.ones(len(own), dtype=bool)
        while waiting.any():  # one component after the other, breadth first: each fingerprint is reached once
            front = [int(np.argmax(waiting))]
            waiting[front[0]] = False
            while front:
                at = front.pop()
                reached = np.flatnonzero(waiting & (np.bitwise_count(own ^ own[at]) <= radius))
                waiting[reached] = False
                links += [(int(own[at]), int(own[r])) for r in reached]
                front += reached.tolist()
    return links


def bucket_links(members: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` inside the buckets of ``members(bucket, fp)``."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: list[np.ndarray], fps: list[np.ndarray]) -> pa.RecordBatch:
            found = forest(np.concatenate(keys), np.concatenate(fps), radius) if keys else []
            fp = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(fp[:, 0]), pa.array(fp[:, 1])], names=["a", "b"])

        # A bucket may go on in the next batch: its rows wait.
        keys: list[np.ndarray] = []
        fps: list[np.ndarray] = []
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1], "left"))
            if last or (keys and keys[-1][-1] != key[-1]):
                yield out([*keys, key[:last]], [*fps, fp[:last]])
                keys, fps = [], []
            keys.append(key[last:])
            fps.append(fp[last:])
        yield out(keys, fps)

    dealt = members.select("bucket", "fp").repartition(common.partitions(members.sparkSession), "bucket").sortWithinPartitions("bucket", "fp")
    return dealt.mapInArrow(work, "a bigint, b bigint")


def sized(members: DataFrame) -> DataFrame:
    """The members of buckets of two or more, with the size of the bucket."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(common.written(sizes, "bucket-sizes"), "bucket")


def near_links(distinct: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` in reach of each other."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(signed(m)).alias("mask")) for t, m in enumerate(masks(radius))])
    members = distinct.select("fp", F.explode(tables).alias("x")).select(
        "fp", F.col("x.t").alias("t"), F.xxhash64("x.t", F.col("fp").bitwiseAND(F.col("x.mask"))).alias("bucket"))
    members = common.written(sized(members), "buckets")
    finer = F.array(*[F.array(*[F.lit(signed(m)) for m in finer_masks(mask, radius)]) for mask in masks(radius)])
    large = members.where(F.col("size") > small).select("fp", "bucket", F.posexplode(F.get(finer, F.col("t"))).alias("i", "mask")).select(
        "fp", F.xxhash64("bucket", "i", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"))
    return bucket_links(members.where(F.col("size") <= small), radius).unionByName(bucket_links(sized(large), radius)).distinct()


def grouped(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row; the component is named by its smallest ``doc_id``."""
    found = common.written(fingerprints(docs, shingle), "fingerprints")
    distinct = common.written(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints-distinct")
    roots = components(common.written(near_links(distinct.select("fp"), radius), "near-links"))
    rooted = common.written(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = common.written(rooted.join(names, "root").select("fp", "component_id"), "fingerprint-components")
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The first document of each component, with all columns. Rows that repeat its id stay together."""
    kept = grouped(docs, radius, shingle).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("__kept")).distinct()
    return docs.join(common.written(kept, "near-kept").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")


runtime.ship_by_value(__name__)
