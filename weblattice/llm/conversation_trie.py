"""Prefix trie of conversations by ROLLUP over positional turn columns.

A turn becomes an id (SHA-256 of role and text) with the length of its text, and a conversation rows of ``WIDTH`` such columns, one for each
block of positions. A further block is keyed by the node that the blocks before it lead to: two 64-bit lanes, each the XOR of the hashes of
(position, turn) on the way. So one ``GROUP BY block, node, ROLLUP (t0, ..., t7)`` aggregates the prefixes of all conversations and all blocks together, and
``grouping_id`` tells the depth of each row.

Sums over subtrees need no walk. The owner of a node is its smallest member, and what a conversation owns is the end of its path. A subtree
is all that its members own, less what its owner owns above it; so a second ROLLUP adds up what members own.

Nothing needs a conversation in one task: places of turns, lanes and sums along a path are running sums over sorted pieces with an offset for each piece (``running``).
Ids of conversations that end at a node are written out in sorted chunks, which are hashed in order one after another.

Rows without a ``conv_id`` belong to no conversation and take no part; null roles and texts are empty; a null turn comes first; rows of equal conversation and turn are
ordered by the SHA-256 of role and text, and repeated rows are turns of their own. Other columns play no part. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common

#: Positions of a block.
WIDTH = 8
#: Of each five neighbouring conversations the first lends its turns, at most MOST of them.
SHARE, MOST = 5, 8
#: Ids of a chunk that is hashed at once.
CHUNK = 4096

TURNS = [f"t{i}" for i in range(WIDTH)]
NODE = ["depth", "id1", "id2"]


def running(rows: DataFrame, key: str, order: list[str], sums: dict[str, Column], aggregate: Callable, add: Callable) -> DataFrame:
    """``rows`` with a column for each of ``sums``: the aggregate of that value over the earlier rows of the key, in order; 0 for the first.

    Rows are sorted into pieces by range, so one key may fill many; each piece sums its own, and the offsets of pieces come from their totals.
    """
    dealt = rows.withColumns({f"__{name}": value for name, value in sums.items()})
    pieces = common.written(dealt.repartitionByRange(common.partitions(rows.sparkSession), key, *order).withColumn("__piece", F.spark_partition_id()), "pieces")
    here = Window.partitionBy(key, "__piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(key).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy(key, "__piece").agg(*[aggregate(f"__{name}").alias(f"__{name}") for name in sums])
    offsets = totals.select(key, "__piece", *[F.coalesce(aggregate(f"__{name}").over(earlier), F.lit(0)).alias(f"__before_{name}") for name in sums])
    local = pieces.withColumns({name: F.coalesce(aggregate(f"__{name}").over(here), F.lit(0)) for name in sums})
    return local.join(offsets, [key, "__piece"]).withColumns({name: add(F.col(name), F.col(f"__before_{name}")) for name in sums}).drop(
        "__piece", *[f"__{name}" for name in sums], *[f"__before_{name}" for name in sums])


def running_sum(rows: DataFrame, key: str, order: list[str], sums: dict[str, Column]) -> DataFrame:
    return running(rows, key, order, sums, F.sum, lambda a, b: a + b)


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, t)``: turns in order from place 0; ``t`` holds the id ``h`` of role and text, and the bytes ``n`` of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.struct(F.unhex(F.sha2(whole.cast("binary"), 256)).alias("h"), F.octet_length(text).cast("bigint").alias("n")).alias("t"),
        F.monotonically_increasing_id().alias("row"))  # spreads repeated rows
    return running_sum(rows, "conv_id", ["turn", "t", "row"], {"place": F.lit(1).cast("bigint")}).select("conv_id", "place", "t")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations as ``(conv_id, place, t)``, and ``(conv_id, length)`` of all of them, also those without a turn.

    Conversation c takes the first h turns of conversation ``c - c % SHARE`` (or all it has), with h = crc32(c) % (MOST + 1), and goes on with its own from place h.
    """
    own = common.written(turns(conversations), "turns")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("size"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST + 1)
    lenders = sizes.select(F.col("conv_id").alias("lender"), F.col("size").alias("lent"))
    plan = common.written(
        sizes.withColumn("h", taken).withColumn("lender", F.col("conv_id") - F.col("conv_id") % SHARE).join(lenders, "lender", "left").select(
            "conv_id", "lender", "h", F.least("h", F.coalesce("lent", F.lit(0))).alias("shared"), F.greatest(F.lit(0), F.col("size") - F.col("h")).alias("rest")),
        "rebuild-plan")
    shared = plan.where("shared > 0").select(F.col("conv_id").alias("c"), F.col("lender").alias("conv_id"), "shared").join(
        own.where(F.col("place") < MOST), "conv_id").where("place < shared").select(F.col("c").alias("conv_id"), "place", "t")
    rest = own.join(plan, "conv_id").where("place >= h").select("conv_id", (F.col("shared") + F.col("place") - F.col("h")).alias("place"), "t")
    return shared.unionByName(rest), plan.select("conv_id", (F.col("shared") + F.col("rest")).alias("length"))


def lanes(place: Column, t: Column) -> list[Column]:
    """Two hashes of a turn at a place; 0 for no turn."""
    return [F.when(t.isNotNull(), F.xxhash64(F.lit(lane), place, t)).otherwise(F.lit(0)) for lane in (1, 2)]


def xor(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def laid_out(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(conv_id, block, length, id1, id2, end1, end2, t0, ...)``: a row for each block of a conversation, the first also of one without turns.

    ``id1, id2`` are the lanes of the node that the block starts from, ``end1, end2`` of the one that it leads to.
    """
    blocks = rows.groupBy("conv_id", F.expr(f"place div {WIDTH}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "t"))).alias("at"))  # WIDTH rows at most
    blocks = blocks.select("conv_id", "block", *[F.get("at", F.lit(i))["t"].alias(name) for i, name in enumerate(TURNS)])
    first = lengths.where("length = 0").select("conv_id", F.lit(0).cast("bigint").alias("block"))
    blocks = blocks.unionByName(first, allowMissingColumns=True)
    hashes = [lanes(F.col("block") * WIDTH + i, F.col(name)) for i, name in enumerate(TURNS)]
    blocks = blocks.withColumns({f"x{lane + 1}": xor([h[lane] for h in hashes]) for lane in (0, 1)})
    led = running(blocks, "conv_id", ["block"], {"id1": F.col("x1"), "id2": F.col("x2")}, F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    return led.withColumns({f"end{i}": F.col(f"id{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)}).drop("x1", "x2").join(lengths, "conv_id")


def rolled(laid: DataFrame, aggregates: str) -> DataFrame:
    """The aggregates over the members of each node, with its ``block``, starting lanes, turn columns up to its own, and ``level`` of the block.

    Levels below a conversation's end are no nodes, and neither is the start of a later block, which is the end of the block before.
    """
    columns, given = ", ".join(TURNS), " + ".join(f"CAST({t} IS NOT NULL AS INT)" for t in TURNS)
    level = f"{WIDTH} - bit_count(grouping_id())"
    return laid.sparkSession.sql(
        f"SELECT block, id1, id2, {columns}, {level} AS level, {aggregates} FROM {{laid}} GROUP BY block, id1, id2, ROLLUP ({columns}) "
        f"HAVING {given} = {level} AND (block = 0 OR {level} > 0)", laid=laid)


def nodes(laid: DataFrame) -> DataFrame:
    """``(conv_id, depth, id1, id2, up1, up2, n_convs, bytes)`` of each node; ``up`` are the lanes of its parent, ``bytes`` those of its last text."""
    found = rolled(laid, "min(conv_id) AS conv_id, count(*) AS n_convs")
    hashes = [lanes(F.col("block") * WIDTH + i, F.col(name)) for i, name in enumerate(TURNS)]
    last = F.get(F.array(*TURNS), F.col("level") - 1)
    depth = F.col("block") * WIDTH + F.col("level")
    step = lanes(depth - 1, last)
    ids = [xor([F.col(f"id{lane + 1}"), *[h[lane] for h in hashes]]) for lane in (0, 1)]
    return found.select(
        "conv_id", depth.alias("depth"), ids[0].alias("id1"), ids[1].alias("id2"), xor([ids[0], step[0]]).alias("up1"), xor([ids[1], step[1]]).alias("up2"),
        "n_convs", F.coalesce(last["n"], F.lit(0)).alias("bytes"))


def end_hashes(laid: DataFrame) -> DataFrame:
    """``(depth, id1, id2, ends_sha256)`` of the nodes at which conversations end: the hash of their ids, ascending, comma-joined.

    Sorted by node and id and dealt by range, ids are written out in chunks, so a node at which many end is spread; then each node's chunks are hashed in order.
    """
    ends = laid.where(F.col("block") == F.expr(f"greatest(length - 1, 0) div {WIDTH}")).select(
        F.col("length").alias("depth"), F.col("end1").alias("id1"), F.col("end2").alias("id2"), "conv_id")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out = []
            for *key, conv_id in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if ids and (key != node or len(ids) == CHUNK):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = key
                ids.append(conv_id)
            yield chunk_batch(out)
        yield chunk_batch([(*node, ids[0], ",".join(map(str, ids)))] if ids else [])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashed = None, None
        for batch in batches:
            out = []
            for *key, _, text in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if key == node:
                    hashed.update(b",")
                else:
                    if node:
                        out.append((*node, hashed.hexdigest()))
                    node, hashed = key, hashlib.sha256()
                hashed.update(text.encode())
            yield hash_batch(out)
        yield hash_batch([(*node, hashed.hexdigest())] if node else [])

    n = common.partitions(laid.sparkSession)
    chunks = ends.repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        join, "depth bigint, id1 bigint, id2 bigint, first bigint, ids string")
    return chunks.repartition(n, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth bigint, id1 bigint, id2 bigint, ends_sha256 string")


def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of numbers with a last column of text."""
    columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in names]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())], names=names)


def chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    return batch_of(rows, [*NODE, "first", "ids"])


def hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    return batch_of(rows, [*NODE, "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations."""
    rows, lengths = rebuilt(conversations)
    return trie_of(rows, lengths)


def trie_of(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie of conversations given as ``(conv_id, place, t)`` with ``(conv_id, length)``."""
    laid = common.written(laid_out(rows, lengths), "trie-blocks")
    found = common.written(nodes(laid), "trie-nodes")
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("id1"), F.col("up2").alias("id2")).agg(
        F.count("*").alias("n_children"))
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("id1").alias("up1"), F.col("id2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    linked = found.join(children, NODE, "left").join(above, ["depth", "up1", "up2"], "left").select(
        "conv_id", *NODE, "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), F.col("n_children").isNull().cast("bigint").alias("leaf"))
    linked = common.written(linked, "trie-links")

    owned = linked.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    sums = rolled(laid.join(owned, "conv_id", "left"), "min(conv_id) AS conv_id, coalesce(sum(saved), 0) AS all_saved, coalesce(sum(leaves), 0) AS all_leaves").select(
        "conv_id", (F.col("block") * WIDTH + F.col("level")).alias("depth"), "all_saved", "all_leaves")
    above = running_sum(linked, "conv_id", ["depth"], {"saved_above": F.col("saved"), "leaves_above": F.col("leaf")})
    return above.join(sums, ["conv_id", "depth"]).join(end_hashes(laid), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("all_leaves") - F.col("leaves_above")).alias("n_leaves"),
        (F.col("all_saved") - F.col("saved_above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


runtime.ship_by_value(__name__)
