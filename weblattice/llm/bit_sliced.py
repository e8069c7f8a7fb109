"""Exact top-k search by inner product over a bit-sliced index of quantised vectors.

The index holds blocks of vectors. For each attribute of a block the smallest value is taken off, and what is left is cut into bit
slices: one bitmap over the block's rows for each binary digit, of which the ``KEEP`` most significant are stored. For a query the slices are
added with bitmap arithmetic: the slices of an attribute, shifted by each digit of its weight, go to columns by binary place, and full adders turn three
bitmaps of a column into one and a carry. Negative weights add the complement. What comes out is a bit-sliced lower bound of each row's
score, off by less than a known error. Going from the most significant slice downward gives the k-th largest bound; rows whose bound is
within the error of it are the boundary, and their scores are computed exactly from the stored vectors.

A search lays queries against blocks in a grid: a cell is one block and a group of about ``GROUP`` queries, and gives the best k of each query there.
Cells are spread over tasks; the best k of all cells of a query follow by rank.

Vectors that are null or hold a null, NaN or infinite component take no part. Vectors meet only those of their own length (empty ones among
themselves, with score 0). Rows that repeat a ``vec_id`` are rows of their own: each is a candidate for the other, and each is a query. A null ``vec_id``
loses ties. Scores beyond 64 bits are set to the nearest number that fits. Other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Components in a block (32,768 vectors of 64), slices kept of an attribute, queries in a batch and, on average, in a cell.
BLOCK_VALUES = 1 << 21
KEEP = 5
BATCH = 64
GROUP = 1024
LONG = np.iinfo(np.int64)

INDEX = "block bigint, dim int, n int, ids binary, no_id binary, chosen binary, vectors binary, width int, low binary, dropped binary, slices binary"
BATCHES = "block bigint, dim int, batch int, places binary, ids binary, vectors binary"
FOUND = "q_block bigint, q_place int, query_id bigint, block bigint, place int, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, q)`` of the vectors that take part."""
    whole = F.col(column).cast("array<double>")
    finite = F.forall(whole, lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    return vectors.where(F.col(column).isNotNull()).where(finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(whole, lambda x: F.floor(x * SCALE).cast("bigint")).alias("q"))


def block_row(number: int, dim: int, ids: list, chosen: list, rows: list) -> list:
    """A block with its slices; ``rows`` are its vectors."""
    v = np.array(rows, dtype=np.int64).reshape(len(rows), dim)
    low = v.min(axis=0) if dim else np.empty(0, dtype=np.int64)
    spread = (v - low).astype(np.uint64)  # right even where the difference passes 63 bits
    bits = np.array([int(x).bit_length() for x in spread.max(axis=0)], dtype=np.int64) if dim else np.empty(0, dtype=np.int64)
    dropped = np.maximum(bits - KEEP, 0)
    words = -(-len(rows) // 64)
    slices = np.zeros((dim, KEEP, words * 8), dtype=np.uint8)
    for i in range(KEEP):
        digit = ((spread >> (dropped + i).astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
        slices[:, i, : -(-len(rows) // 8)] = np.packbits(digit.T, axis=1, bitorder="little")
    width = next(w for w in (1, 2, 4, 8) if dim == 0 or (v.min() >= -(1 << (8 * w - 1)) and v.max() < 1 << (8 * w - 1)))
    numbers = np.array([0 if i is None else i for i in ids], dtype="<i8")
    return [number, dim, len(rows), numbers.tobytes(), np.array([i is None for i in ids]).tobytes(), np.array(chosen, dtype=bool).tobytes(),
            v.astype(f"<i{width}").tobytes(), width, low.astype("<i8").tobytes(), dropped.astype("<i8").tobytes(), slices.tobytes()]


INDEX_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def build(vectors: DataFrame, chosen: Column, column: str = "embedding") -> DataFrame:
    """The index as a written table. ``chosen`` (over ``vec_id``) marks the rows that will be queries."""
    rows = quantised(vectors, column).select("vec_id", F.coalesce(chosen, F.lit(False)).alias("chosen"), "q")
    values = rows.agg(F.sum(F.size("q").cast("bigint") + 1)).head()[0] or 0

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, {}, 0

        def flushed():
            nonlocal number
            for dim, (ids, marks, rows_) in held.items():
                made = block_row(number, dim, ids, marks, rows_)
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, INDEX_TYPES, strict=True)], names=[c.split()[0] for c in INDEX.split(", ")])

        for batch in batches:
            for vec_id, mark, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                vector = q.values.to_numpy()
                ids, marks, rows_ = held.setdefault(len(vector), ([], [], []))
                ids.append(vec_id)
                marks.append(mark)
                rows_.append(vector)
                size += len(vector) + 1
                if size >= BLOCK_VALUES:
                    yield from flushed()
                    held, size = {}, 0
        yield from flushed()

    return common.written(rows.repartition(max(1, -(-values // BLOCK_VALUES))).mapInArrow(pack, INDEX), "bit-sliced")


def query_batches(index: DataFrame) -> DataFrame:
    """The marked rows of each block, ``BATCH`` in a row, with their places there."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, dim, ids, marks, vectors, width = (batch.column(c)[i] for c in ("block", "dim", "ids", "chosen", "vectors", "width"))
                dim = dim.as_py()
                places = np.nonzero(np.frombuffer(marks.as_buffer(), dtype=bool))[0].astype("<i4")
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                v = np.frombuffer(vectors.as_buffer(), f"<i{width.as_py()}").reshape(len(ids), dim)
                for number, start in enumerate(range(0, len(places), BATCH)):
                    own = places[start:start + BATCH]
                    made = [block.as_py(), dim, number, own.tobytes(), ids[own].tobytes(), v[own].astype("<i8").tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in zip(made, (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)],
                        names=[c.split()[0] for c in BATCHES.split(", ")])

    return index.select("block", "dim", "ids", "chosen", "vectors", "width").mapInArrow(cut, BATCHES)


class Cell:
    """A block laid out for queries."""

    def __init__(self, row: dict) -> None:
        self.block, self.dim, self.n = row["block"], row["dim"], row["n"]
        self.ids, self.no_id = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["no_id"], bool)
        self.vectors = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(self.n, self.dim)
        self.low, self.dropped = np.frombuffer(row["low"], "<i8"), np.frombuffer(row["dropped"], "<i8")
        self.words = -(-self.n // 64)
        slices = np.frombuffer(row["slices"], "<u8").reshape(self.dim * KEEP, self.words)
        self.stack = np.concatenate([slices, ~slices])  # then the complements
        every = np.zeros(self.words * 8, dtype=np.uint8)
        every[: -(-self.n // 8)] = np.packbits(np.ones(self.n, dtype=np.uint8), bitorder="little")
        self.every = every.view("<u8")
        self.top = [abs(int(x)) for x in (self.vectors.min(), self.vectors.max())] if self.dim else [0]

    def bounds(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices of the lower bound of every row, least significant first, and the error: no row's score is that far above its bound, or farther."""
        weight = np.abs(q)
        place, digit = np.nonzero((weight[:, None] >> np.arange(int(weight.max()).bit_length())) & 1)
        column = (self.dropped[place] + digit)[:, None] + np.arange(KEEP)
        source = (place * KEEP + (q[place] < 0) * self.dim * KEEP)[:, None] + np.arange(KEEP)
        column, source = column.ravel(), source.ravel()
        order = np.argsort(column, kind="stable")
        column, source = column[order], source[order]
        out, carries, c, last = [], [], 0, int(column[-1])
        while c <= last or carries:
            own = source[np.searchsorted(column, c):np.searchsorted(column, c, side="right")]
            m, carries = np.concatenate([self.stack[own], *carries]), []
            while len(m) > 2:
                k = len(m) // 3
                x, y, z = m[:k], m[k:2 * k], m[2 * k:3 * k]
                either = x ^ y
                carries.append((x & y) | (either & z))
                m = np.concatenate([either ^ z, m[3 * k:]])
            if len(m) == 2:
                carries.append((m[0] & m[1])[None])
                m = (m[0] ^ m[1])[None]
            out.append(m[0] if len(m) else np.zeros(self.words, dtype=np.uint64))
            c += 1
        return out, int(np.sum(weight * ((1 << self.dropped) - 1))) + 1

    def boundary(self, q: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """Bitmap of the rows that may be among the best k of ``rows``."""
        if int(np.bitwise_count(rows).sum()) <= k or not q.any():
            return rows
        slices, error = self.bounds(q)
        sure, ties, kth = np.zeros_like(rows), rows, 0
        for i in range(len(slices) - 1, -1, -1):
            with_digit = ties & slices[i]
            if int(np.bitwise_count(sure | with_digit).sum()) >= k:
                ties, kth = with_digit, kth | 1 << i
            else:
                sure, ties = sure | with_digit, ties & ~slices[i]
        least = max(0, kth - error + 1)
        above, equal = np.zeros_like(rows), rows
        for i in range(len(slices) - 1, -1, -1):
            if least >> i & 1:
                equal = equal & slices[i]
            else:
                above, equal = above | (equal & slices[i]), equal & ~slices[i]
        return above | equal

    def best(self, q: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, list[int]]:
        """Places and scores of the best k rows; ``own`` is left out."""
        rows = self.every.copy()
        if own is not None:
            rows[own >> 6] &= ~np.uint64(1 << (own & 63))
        if self.dim * (2 * max(self.top) + 1) * (int(max(abs(int(q.min())), abs(int(q.max())))) + 1 if self.dim else 1) < 1 << 62:
            places = np.nonzero(np.unpackbits(self.boundary(q, rows, k).view(np.uint8), bitorder="little"))[0]
            scores = self.vectors[places].astype(np.int64) @ q
        else:  # beyond what slices of 62 bits can add
            places = np.nonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))[0]
            exact = self.vectors[places].astype(object) @ q.astype(object)
            scores = np.array([min(max(s, LONG.min), LONG.max) for s in exact.tolist()], dtype=np.int64)
        order = np.lexsort((self.ids[places], self.no_id[places], -np.maximum(scores, LONG.min + 1)))[:k]
        return places[order], scores[order].tolist()


def search(index: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for each marked row of the index."""
    numbered = index.select("block", "dim").withColumn("number", F.row_number().over(Window.partitionBy("dim").orderBy("block")))  # one small row a block
    sizes = numbered.groupBy("dim").agg(F.count("*").cast("int").alias("n_blocks"))
    batches = common.written(query_batches(index), "query-batches")
    groups = max(1, -(-batches.count() * BATCH // GROUP))
    cells = index.join(numbered, ["block", "dim"]).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    queries = (
        batches.withColumn("group", F.pmod(F.xxhash64("block", "batch"), F.lit(groups)).cast("int")).withColumnRenamed("block", "q_block")
        .join(sizes, "dim").withColumn("number", F.explode(F.sequence(F.lit(1), F.col("n_blocks")))).drop("n_blocks"))

    def meet(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(7)]
        if blocks.num_rows and asked.num_rows:
            cell = Cell(blocks.to_pylist()[0])
            for row in asked.to_pylist():
                places, ids = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["ids"], "<i8")
                for place, query_id, q in zip(places.tolist(), ids.tolist(), np.frombuffer(row["vectors"], "<i8").reshape(len(ids), -1), strict=True):
                    found, scores = cell.best(q, place if row["q_block"] == cell.block else None, k)
                    m = len(found)
                    named = [None if cell.no_id[p] else int(cell.ids[p]) for p in found]
                    for column, new in zip(out, ([row["q_block"]] * m, [place] * m, [query_id] * m, [cell.block] * m, found.tolist(), named, scores), strict=True):
                        column += new
        return pa.table({c.split()[0]: pa.array(x, pa.int32() if c.endswith(" int") else pa.int64()) for c, x in zip(FOUND.split(", "), out, strict=True)})

    key = ["dim", "number", "group"]
    found = cells.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(meet, FOUND)
    best_first = Window.partitionBy("q_block", "q_place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "block", "place")
    return common.written(found, "bit-sliced-found").withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


runtime.ship_by_value(__name__)
