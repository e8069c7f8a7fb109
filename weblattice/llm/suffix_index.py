"""Suffix-array dedup with a logarithmic family of indexes: every byte of a string of ``length`` bytes that starts anywhere else goes.

**Sampled suffixes.** The suffixes that are indexed start at anchors. Of each window of ``length`` bytes, the smallest hash of its strings of
``gram`` bytes is taken: an anchor depends on the window's bytes only, so equal windows have anchors at equal places, and about one
suffix in a hundred is enough to find all matches. Suffixes are ranked by the hash of their first ``gram`` bytes: equal prefixes stand
together, which is all that a scan for long matches uses; alphabetical order among unequal ones is not needed.

**Levels.** Documents come in batches. A batch's suffixes are sorted into an array (a table bucketed and sorted by rank, one row for each
distinct prefix), which is merged by a scan with every level of the family: equal ranks are matches of at least ``gram`` bytes. Then the array
joins the family; levels of equal size merge to the next, so a suffix is rewritten log(batches) times.

**Extension.** A suffix that matched is looked at with its context: all bytes of the windows that hold its gram. If a whole context stands
twice, all those windows repeat. What is left (the ends of repeats) is compared window by window, by hashes of what stands left and
right of the gram: in one task for ranks of few contexts, and as rows that are counted by hash for the others.

Hashes have 64 bits, and a match takes two of them. A null text is the empty text. Texts below ``length`` bytes lose nothing.
Rows that repeat a ``doc_id`` are documents of their own, so equal long ones lose all they share. Other columns play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common

LENGTH, GRAM, BATCHES = 400, 200, 4
#: Contexts of one rank that one task compares; further ranks are compared as rows.
SMALL = 100
#: Distances that are first looked at together there.
BLOCK = 25
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 21

MULTIPLIER = 0x9E3779B97F4A7C15 | 1
WORD = (1 << 64) - 1


@dataclass(frozen=True)
class Shape:
    length: int = LENGTH
    gram: int = GRAM

    @property
    def reach(self) -> int:
        """Bytes on either side of a gram that a window may hold."""
        return self.length - self.gram


SHAPE = Shape()


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & WORD)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of all strings of a text by prefix sums: sum of byte codes times powers, divided by the power at the start."""

    def __init__(self, size: int) -> None:
        self.codes = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        inverse = pow(MULTIPLIER, -1, 1 << 64)
        self.powers, self.inverses = self._powers(MULTIPLIER, size), self._powers(inverse, size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(data) + 1, dtype=np.uint64)
        out[0] = 0
        np.cumsum(self.codes[data] * self.powers[:len(data)], out=out[1:])
        return out

    def strings(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverses[start]


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over each run of so many neighbours."""
    have, out = 1, x
    while 2 * have <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return best(out[:-rest], out[rest:]) if rest else out


def anchors(text: bytes, roll: Rolling, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places, ranks, context hashes, and the context's bytes left and right of the gram, for one text."""
    size, found = len(text), []
    data = np.frombuffer(text, dtype=np.uint8)
    for begin in range(0, max(size - shape.length + 1, 0), CHUNK):
        end = min(begin + CHUNK, size - shape.length + 1)  # windows that start in begin..end
        low, high = max(0, begin - shape.reach), min(size, end - 1 + shape.length + shape.reach)
        sums = roll.sums(data[low:high])
        first, last = begin - low, end - 1 + shape.length - low
        hashes = mixed((sums[first + shape.gram:last + 1] - sums[first:last + 1 - shape.gram]) * roll.inverses[first:last + 1 - shape.gram], 1)
        least = sliding(hashes, shape.reach + 1, np.minimum)
        padded = np.zeros(len(least) + 2 * shape.reach, dtype=np.uint64)
        padded[shape.reach:shape.reach + len(least)] = least
        at = np.flatnonzero(hashes == sliding(padded, shape.reach + 1, np.maximum))
        place = at + begin
        left = np.minimum(place, shape.reach)
        right = np.minimum(size - place - shape.gram, shape.reach)
        local = place - low
        whole = mixed(roll.strings(sums, local - left, local + shape.gram + right) + (left * 1009 + right).astype(np.uint64), 2)
        found.append((place, hashes[at], whole, left, right))
    if not found:
        return tuple(np.empty(0, dtype=t) for t in ("i8", "u8", "u8", "i8", "i8"))  # type: ignore[return-value]
    out = tuple(np.concatenate(x) for x in zip(*found, strict=True))
    if len(found) > 1:  # neighbouring chunks may both find an anchor
        _, keep = np.unique(out[0], return_index=True)
        out = tuple(x[keep] for x in out)
    return out  # type: ignore[return-value]


ANCHORS = "doc_id bigint, text_key bigint, batch int, place bigint, rank bigint, context bigint, before smallint, after smallint"


def sampled(docs: DataFrame, shape: Shape, batches: int) -> DataFrame:
    """The anchors of every document, with the batch it comes in (by a hash of the document)."""

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Rolling(CHUNK + 4 * shape.length)
        for frame in frames:
            parts, counts = [], []
            for x in frame.column(3):
                found = anchors(x.as_buffer().to_pybytes(), roll, shape)
                parts.append(found)
                counts.append(len(found[0]))
            rows = np.repeat(np.arange(len(counts)), counts)
            place, rank, context, left, right = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.empty(0, "i8")] * 5
            ids = frame.select([0, 1, 2]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*ids.columns, pa.array(place, pa.int64()), pa.array(rank.view(np.int64)), pa.array(context.view(np.int64)),
                 pa.array(left.astype(np.int16)), pa.array(right.astype(np.int16))],
                names=["doc_id", "text_key", "batch", "place", "rank", "context", "before", "after"])

    text = common.whole_text()
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(batches)).cast("int").alias("batch"), text.cast("binary").alias("text"))
    return rows.where(F.length("text") >= shape.length).mapInArrow(work, ANCHORS)


class Family:
    """Levels of sorted arrays. Level k holds 2^k batches; what a batch matches is kept in ``found``."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.levels, self.found, self.buckets = spark, {}, [], common.partitions(spark)

    def _store(self, rows: DataFrame) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.buckets, "rank").sortBy("rank").saveAsTable(name)
        return name

    def _read(self, name: str) -> DataFrame:
        return self.spark.table(name).hint("merge")

    def add(self, suffixes: DataFrame) -> None:
        """Sort a batch's suffixes, scan them against every level, and let equal levels merge."""
        # Summed up in map tasks first: a prefix of a third of all suffixes is a few rows.
        array = self._store(suffixes.groupBy("rank").agg(
            F.count("*").alias("suffixes"), F.min("context").alias("low"), F.max("context").alias("high")))
        self.found.append(common.written(self._read(array).where("suffixes > 1").select("rank", "low", "high"), "suffix-matches"))
        for level in self.levels.values():
            joined = self._both(array, level, "inner")
            self.found.append(common.written(joined.select("rank", "low", "high"), "suffix-matches"))
        k = 0
        while k in self.levels:
            other = self.levels.pop(k)
            merged = self._store(self._both(array, other, "full"))
            for name in (array, other):
                self.spark.sql(f"DROP TABLE {name}")
            array, k = merged, k + 1
        self.levels[k] = array

    def _both(self, one: str, other: str, how: str) -> DataFrame:
        """Two arrays as one. Both are bucketed and sorted by rank and unique in it, so this is a merge without a shuffle."""
        a, b = self._read(one).alias("a"), self._read(other).alias("b")
        return a.join(b, F.col("a.rank") == F.col("b.rank"), how).select(
            F.coalesce("a.rank", "b.rank").alias("rank"),
            (F.coalesce("a.suffixes", F.lit(0)) + F.coalesce("b.suffixes", F.lit(0))).alias("suffixes"),
            F.least("a.low", "b.low").alias("low"), F.greatest("a.high", "b.high").alias("high"))

    def matches(self) -> DataFrame:
        """``(rank, several)``: prefixes that stand in two places or more, and whether their contexts differ."""
        out = self.found[0]
        for more in self.found[1:]:
            out = out.unionByName(more)
        return out.groupBy("rank").agg(F.min("low").alias("low"), F.max("high").alias("high")).select("rank", (F.col("low") != F.col("high")).alias("several"))

    def drop(self) -> None:
        for name in self.levels.values():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = {}


def side_sums(side: np.ndarray, reach: int) -> np.ndarray:
    """Hashes of the first 0, 1, ... bytes of each row of one side."""
    roll = Rolling(reach + 1)
    out = np.zeros((len(side), reach + 1), dtype=np.uint64)
    np.cumsum(roll.codes[side] * roll.powers[:reach], axis=1, out=out[:, 1:])
    return out


def joint(left: np.ndarray, right: np.ndarray, rank: np.ndarray, salt: int) -> np.ndarray:
    """The hash of a string around a gram, from its two sides and the gram's own hash."""
    return mixed(mixed(left, 3) + mixed(right, 4) * np.uint64(MULTIPLIER) + mixed(rank, 5), salt)


def window_hashes(rank: np.ndarray, before: np.ndarray, left: np.ndarray, after: np.ndarray, right: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each distance d of a window's start before the gram: its hash, and whether there is such a window.

    ``left`` holds the bytes before the gram from near to far, ``right`` those after it, both filled up with zeros.
    """
    reach, distance = shape.reach, np.arange(shape.reach + 1)
    hashes = joint(side_sums(left, reach), side_sums(right, reach)[:, ::-1], rank[:, None] + distance[None, :].astype(np.uint64), 6)
    return hashes, (distance[None, :] <= before[:, None]) & (reach - distance[None, :] <= after[:, None])


def runs(place: int, marked: np.ndarray, shape: Shape) -> list[tuple[int, int]]:
    """The bytes that windows at the marked distances cover, as maximal runs of distances."""
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return [(place - int(e) + 1, place - int(s) + shape.length) for s, e in zip(edges[::2], edges[1::2], strict=True)]


CONTEXTS = "doc_id bigint, text_key bigint, place bigint, rank bigint, many boolean, known boolean, before binary, after binary"


def contexts(docs: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """The bytes around the wanted anchors ``(doc_id, text_key, at)``; ``at`` is an array of their places and flags."""

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            out: list[tuple] = []
            for doc_id, key, text, at in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                for a in at:
                    p, q = a["place"], a["place"] + shape.gram
                    out.append((doc_id, key, p, a["rank"], a["many"], a["known"], text[max(0, p - shape.reach):p], text[q:q + shape.reach]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "text_key", "place", "rank", "many", "known", "before", "after"])

    text = common.whole_text()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))
    right = wanted.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "at").hint("shuffle_hash")
    joined = rows.join(right, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")))
    # Rows that repeat id and text give the same contexts; one is enough.
    return joined.select("doc_id", "text_key", "text", "at").mapInArrow(work, CONTEXTS).dropDuplicates(["doc_id", "text_key", "place"])


def unpacked(frame: pa.RecordBatch, reach: int) -> tuple[np.ndarray, ...]:
    """Rank, and lengths and bytes on both sides, of rows of ``contexts``."""
    rank = frame.column("rank").to_numpy(zero_copy_only=False).view(np.uint64)
    out: list[np.ndarray] = [rank]
    for name, step in (("before", -1), ("after", 1)):
        side = np.zeros((len(rank), reach), dtype=np.uint8)
        sizes = np.zeros(len(rank), dtype=np.int64)
        for i, x in enumerate(frame.column(name).to_pylist()):
            sizes[i] = len(x)
            side[i, :len(x)] = np.frombuffer(x, dtype=np.uint8)[::step]
        out += [sizes, side]
    return tuple(out)


SPANS = "doc_id bigint, text_key bigint, low bigint, high bigint"
BLOCKS = "doc_id bigint, text_key bigint, place bigint, known boolean, block int, core bigint, whole bigint, low bigint, high bigint"
HASHED = "doc_id bigint, text_key bigint, place bigint, known boolean, distance int, window bigint"


def spans_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["doc_id", "text_key", "low", "high"])


def compared_in_task(rows: DataFrame, shape: Shape) -> DataFrame:
    """Spans of windows that stand twice among the contexts of a rank, for ranks of few contexts."""

    def repeated(frame: pa.RecordBatch) -> pa.RecordBatch:
        rank, before, left, after, right = unpacked(frame, shape.reach)
        hashes, there = window_hashes(rank, before, left, after, right, shape)
        marked = np.zeros(there.shape, dtype=bool)
        for d in range(shape.reach + 1):
            row = np.flatnonzero(there[:, d])
            own = hashes[row, d]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            marked[row[order[1:][same]], d] = True
            marked[row[order[:-1][same]], d] = True
        marked[frame.column("known").to_numpy(zero_copy_only=False).astype(bool)] = False  # marked as a whole already
        ids, keys, places = (frame.column(n).to_pylist() for n in ("doc_id", "text_key", "place"))
        return spans_batch([(ids[i], keys[i], low, high) for i in np.flatnonzero(marked.any(axis=1)) for low, high in runs(places[i], marked[i], shape)])

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for big in frames:
            for at in range(0, big.num_rows, 2048):
                frame = big.slice(at, 2048)
                rank = frame.column("rank").to_numpy(zero_copy_only=False)
                last = int(np.flatnonzero(rank == rank[-1])[0])  # a rank may go on in the next batch: its rows wait
                if last or (waiting and waiting[-1].column("rank")[0].as_py() != rank[-1]):
                    yield repeated(joined([*waiting, frame.slice(0, last)]))
                    waiting = []
                waiting.append(frame.slice(last))
        if waiting:
            yield repeated(joined(waiting))

    def joined(frames: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.concat_batches(frames)

    dealt = rows.repartition(common.partitions(rows.sparkSession), "rank").sortWithinPartitions("rank")
    return dealt.mapInArrow(work, SPANS)


def compared_as_rows(rows: DataFrame, shape: Shape) -> DataFrame:
    """The same for ranks of many contexts, as rows that are counted by hash.

    Distances go in blocks. The core of a block are the bytes that all its windows hold, its union all bytes that any of them holds. A core that
    stands once has no repeated window; a union that stands twice repeats in all its windows. Only where different unions share a core, one
    place of each is looked at window by window.
    """
    blocks = common.written(rows.mapInArrow(lambda frames: block_rows(frames, shape), BLOCKS), "suffix-blocks")
    unions = common.written(blocks.groupBy("core", "whole").agg(
        F.count("*").alias("times"), F.max("known").alias("known"), F.min(F.struct("doc_id", "text_key", "place", "block")).alias("first")), "suffix-unions")
    twice = unions.where("times > 1").select("core", "whole")
    in_blocks = blocks.where("not known").join(twice, ["core", "whole"]).select("doc_id", "text_key", "low", "high")

    shared = common.written(unions.groupBy("core").agg(F.count("*").alias("unions")).where("unions > 1").select("core"), "suffix-cores")
    wanted = unions.join(shared, "core").select("first.*", (F.col("known") | (F.col("times") > 1)).alias("marked")).groupBy(
        "doc_id", "text_key", "place").agg(F.collect_list(F.struct("block", "marked")).alias("blocks"))
    right = wanted.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("place").alias("__place"), "blocks")
    there = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")) & (F.col("place") == F.col("__place"))
    looked_at = rows.join(right, there).select("doc_id", "text_key", "place", "rank", "before", "after", "blocks")
    hashed = common.written(looked_at.mapInArrow(lambda frames: window_rows(frames, shape), HASHED), "suffix-windows")
    repeated = common.written(hashed.groupBy("window").agg(F.count("*").alias("times")).where("times > 1").select("window"), "suffix-windows-twice")
    start = F.col("place") - F.col("distance")
    found = hashed.where("not known").join(repeated, "window")
    return in_blocks.unionByName(found.select("doc_id", "text_key", start.alias("low"), (start + shape.length).alias("high")))


def block_rows(frames: Iterable[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """For each context and block of distances with a window: hashes of core and union, and the union's bytes."""
    reach = shape.reach
    for big in frames:
        for at in range(0, big.num_rows, 2048):
            frame = big.slice(at, 2048)
            rank, before, left, after, right = unpacked(frame, reach)
            left_sums, right_sums = side_sums(left, reach), side_sums(right, reach)
            row = np.arange(len(rank))
            place = frame.column("place").to_numpy(zero_copy_only=False)
            own = frame.select(["doc_id", "text_key", "place", "known"])
            for number, low in enumerate(range(0, reach + 1, BLOCK)):
                high = min(low + BLOCK - 1, reach)
                use = np.flatnonzero((before >= low) & (after >= reach - high))
                if not len(use):
                    continue
                far, near = np.minimum(high, before[use]), np.minimum(reach - low, after[use])
                core = joint(left_sums[row[use], low], right_sums[row[use], reach - high], rank[use], 7 + number)
                whole = joint(left_sums[row[use], far], right_sums[row[use], near], rank[use] + (far * 1009 + near).astype(np.uint64), 107 + number)
                yield pa.RecordBatch.from_arrays(
                    [*own.take(pa.array(use)).columns, pa.array(np.full(len(use), number, dtype=np.int32)), pa.array(core.view(np.int64)),
                     pa.array(whole.view(np.int64)), pa.array(place[use] - far), pa.array(place[use] + shape.gram + near)],
                    names=["doc_id", "text_key", "place", "known", "block", "core", "whole", "low", "high"])


def window_rows(frames: Iterable[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """For each context: the hashes of its windows in the blocks that are asked for."""
    for big in frames:
        for at in range(0, big.num_rows, 1024):
            frame = big.slice(at, 1024)
            hashes, there = window_hashes(*unpacked(frame, shape.reach), shape)
            asked, marked = np.zeros_like(there), np.zeros_like(there)
            for i, blocks in enumerate(frame.column("blocks").to_pylist()):
                for b in blocks:
                    part = slice(b["block"] * BLOCK, (b["block"] + 1) * BLOCK)
                    asked[i, part], marked[i, part] = True, b["marked"]
            row, distance = np.nonzero(there & asked)
            own = frame.select(["doc_id", "text_key", "place"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(marked[row, distance]), pa.array(distance.astype(np.int32)), pa.array(hashes[row, distance].view(np.int64))],
                names=["doc_id", "text_key", "place", "known", "distance", "window"])


def repeated_spans(docs: DataFrame, shape: Shape = SHAPE, batches: int = BATCHES, small: int = SMALL) -> DataFrame:
    """``(doc_id, text_key, spans)``: runs of bytes, not merged, that repeated windows cover."""
    spark = docs.sparkSession
    path = runtime.new_folder(spark, "suffixes")
    sampled(docs, shape, batches).write.partitionBy("batch").parquet(path)
    suffixes = spark.read.schema(ANCHORS).parquet(path)
    family = Family(spark)
    for batch in range(batches):
        family.add(suffixes.where(F.col("batch") == batch))
    matches = common.written(family.matches(), "suffix-matched")
    family.drop()
    matched = common.written(suffixes.drop("batch").join(matches, "rank"), "suffix-candidates")
    whole = F.struct((F.col("place") - F.col("before")).alias("low"), (F.col("place") + shape.gram + F.col("after")).alias("high"))
    one_context = matched.where("not several").select("doc_id", "text_key", whole.alias("span"))

    several = matched.where("several")
    first = F.min(F.struct("doc_id", "text_key", "place"))
    classes = common.written(several.groupBy("rank", "context").agg(F.count("*").alias("times"), first.alias("first")), "suffix-contexts")
    # A context that stands twice repeats in all its windows.
    known = several.join(classes.where("times > 1").select("rank", "context"), ["rank", "context"]).select("doc_id", "text_key", whole.alias("span"))
    sizes = common.written(classes.groupBy("rank").agg(F.count("*").alias("contexts")).where("contexts > 1"), "suffix-context-counts")
    wanted = classes.join(sizes, "rank").select("first.*", F.struct(
        F.col("first.place").alias("place"), "rank", (F.col("contexts") > small).alias("many"), (F.col("times") > 1).alias("known")).alias("a"))
    wanted = wanted.groupBy("doc_id", "text_key").agg(F.collect_list("a").alias("at"))
    around = common.written(contexts(docs, wanted, shape), "suffix-surroundings")
    ends = compared_in_task(around.where("not many"), shape).unionByName(compared_as_rows(around.where("many"), shape))
    ends = ends.select("doc_id", "text_key", F.struct("low", "high").alias("span"))
    spans = one_context.unionByName(known).unionByName(ends)
    return spans.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans"))



def remains(docs: DataFrame, shape: Shape = SHAPE, batches: int = BATCHES, small: int = SMALL) -> DataFrame:
    """``(doc_id, n_bytes, runs, kept)`` of every document: the maximal removed runs, and the remaining bytes."""
    spans = common.written(repeated_spans(docs, shape, batches, small), "suffix-spans")
    text = common.whole_text()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))
    # The texts are shuffled, but not sorted: the spans of a partition's documents are the table to look up.
    right = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.sort_array("spans").alias("spans")).hint("shuffle_hash")
    joined = rows.join(right, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left")

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            sizes, gone, kept = [], [], []
            for text, spans in zip(frame.column(1), frame.column(2), strict=True):
                text = text.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                for span in spans.as_py() or []:
                    if merged and span["low"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span["high"])
                    else:
                        merged.append([span["low"], span["high"]])
                edges = [0, *(e for m in merged for e in m), len(text)]
                sizes.append(len(text))
                gone.append([{"low": low, "high": high} for low, high in merged])
                kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)) if merged else text)
            run = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), pa.array(sizes, pa.int64()), pa.array(gone, run), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "runs", "kept"])

    return joined.select("doc_id", "text", "spans").mapInArrow(
        work, "doc_id bigint, n_bytes bigint, runs array<struct<low: bigint, high: bigint>>, kept binary")


def digest(rows: DataFrame) -> DataFrame:
    """Counts and the digest of what remains, from the rows of ``remains``."""
    removed = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["high"] - r["low"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("runs").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


runtime.ship_by_value(__name__)
