"""A stored set of visited urls in parts, of which a lookup reads only the pieces that may hold what it looks for.

A run adds a part. Its urls lie in pieces of about ``URLS_A_PIECE`` by ranges, and beside each piece stand its first and last url
and a Bloom filter. Candidates are laid against ranges, then against the filters of the pieces they fall into; pieces with a possible hit are read for the
exact anti-join, all others stay closed. Filters only spare reading, so the answer does not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weblattice import schemas
from weblattice.runtime import ship_by_value
from weblattice.sources.snapshots import write_once

URLS_A_PIECE = 1_000_000
BITS_A_URL = 12
HASHES = 8
# Ranges that are broadcast to the candidates; a store with more pieces is read whole.
MOST_PIECES = 50_000
_FILTER = "piece int, lo string, hi string, n bigint, bits binary"
_FILTERS = f"{_FILTER}, batch int"


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each hash: two halves, the second added again and again; ``bits`` is a power of two."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield (low + np.uint64(i) * high) & np.uint64(bits - 1)


def _make_filter(urls: pa.Table) -> pa.Table:
    """One row for the urls ``(piece, url, hash)`` of a piece."""
    bits = 1 << max(6, (urls.num_rows * BITS_A_URL - 1).bit_length())
    filled = np.zeros(bits >> 3, dtype=np.uint8)
    for places in _places(urls.column("hash").to_numpy().astype(np.int64).view(np.uint64), bits):
        np.bitwise_or.at(filled, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
    names = urls.column("url").to_pylist()
    return pa.table({
        "piece": pa.array([urls.column("piece")[0].as_py()], pa.int32()), "lo": [min(names)], "hi": [max(names)],
        "n": pa.array([len(names)], pa.int64()), "bits": pa.array([filled.tobytes()], pa.binary())})


def _touched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with a possible hit, from rows ``(batch, piece, bits, hash)`` in which each piece's filter comes before its candidates."""
    piece, filled, found = None, None, False
    for rows in batches:
        out = []
        keys = np.stack([rows.column("batch").to_numpy(), rows.column("piece").to_numpy()])
        cuts = (np.nonzero((np.diff(keys) != 0).any(axis=0))[0] + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, rows.num_rows], strict=True):
            if (own := tuple(keys[:, start].tolist())) != piece:
                piece, found = own, False
                filled = np.frombuffer(rows.column("bits")[start].as_py(), dtype=np.uint8)
                start += 1
            if not found and start < end:
                hashes = rows.column("hash").slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                hit = np.ones(len(hashes), dtype=bool)
                for places in _places(hashes, len(filled) << 3):
                    hit &= (filled[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if hit.any():
                    found = True
                    out.append(piece)
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int32()) for i in (0, 1)], names=["batch", "piece"])


@dataclass(frozen=True)
class VisitedStore:
    """The parts ``numbers`` under ``root``; each holds urls with the columns of the visited set."""

    spark: SparkSession
    root: str
    numbers: tuple[int, ...]

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self.numbers:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*[f"{self.root}/{name}/batch={n}" for n in self.numbers])

    def all(self) -> DataFrame:
        """Every visited url."""
        return self._read("urls", f"{schemas.VISITED}, batch int, piece int").drop("batch", "piece")

    def touched(self, candidates: DataFrame) -> list[tuple[int, int]] | None:
        """``(batch, piece)`` of the pieces that may hold a candidate; None if there are too many pieces to tell."""
        filters = self._read("filters", _FILTERS)
        if not self.numbers:
            return []
        if filters.count() > MOST_PIECES:
            return None
        ranges = F.broadcast(filters.select("batch", "piece", "lo", "hi"))
        asked = candidates.select("url", F.xxhash64("url").alias("hash")).join(ranges, F.col("url").between(F.col("lo"), F.col("hi")))
        rows = filters.select("batch", "piece", F.lit(0).alias("kind"), "bits", F.lit(None).cast("bigint").alias("hash")).unionByName(
            asked.select("batch", "piece", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("bits"), "hash"))
        found = rows.repartition("batch", "piece").sortWithinPartitions("batch", "piece", "kind").drop("kind").mapInArrow(_touched, "batch int, piece int")
        return sorted(tuple(r) for r in found.collect())  # pieces only, MOST_PIECES at most

    def unknown(self, candidates: DataFrame) -> DataFrame:
        """The candidates whose ``url`` is in no part. They are read twice: hand in a written table."""
        touched = self.touched(candidates)
        if touched is None:
            return candidates.join(self.all().select("url"), "url", "left_anti")
        if not touched:
            return candidates
        known = self.spark.read.schema("url string").parquet(*[f"{self.root}/urls/batch={batch}/piece={piece}" for batch, piece in touched])
        return candidates.join(known, "url", "left_anti")

    def add(self, found: DataFrame, number: int) -> VisitedStore:
        """Write the urls ``found`` as part ``number`` (left alone if it is complete) and give the store with it."""
        pieces = max(1, -(-found.count() // URLS_A_PIECE))
        dealt = found.repartitionByRange(pieces, "url").withColumn("piece", F.spark_partition_id()).sortWithinPartitions("piece", "url")
        write_once(dealt, f"{self.root}/urls/batch={number}", "piece")
        urls = self.spark.read.schema(f"{schemas.VISITED}, piece int").parquet(f"{self.root}/urls/batch={number}")
        made = urls.select("piece", "url", F.xxhash64("url").alias("hash")).groupBy("piece").applyInArrow(_make_filter, _FILTER)  # a piece is of bounded size
        write_once(made, f"{self.root}/filters/batch={number}")
        return VisitedStore(self.spark, self.root, (*[n for n in self.numbers if n != number], number))


ship_by_value(__name__)
