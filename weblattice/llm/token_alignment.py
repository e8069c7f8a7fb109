"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and how often each pair of ids ends together.

A text is cut wherever a token of A and a token of B end at the same byte. Most groups are one token of A and the one token of B with the
same bytes. For these the pair follows from the id of A by an array made once, so they are counted in a vector of the vocabulary's length. Only the last
pairs of the other groups are shuffled, summed first over a block of documents.

Three steps over a written table of blocks (documents of about ``BLOCK_BYTES`` bytes together):

1. Encode, align, and write for each block its documents and a dictionary of its distinct links, with how often each document holds each.
2. Sum identity links to a vector and other links by pair. The vector and the highest count of each id of B are bounded by the
   vocabularies and come to the driver; the pairs stay a table.
3. Give each block the totals of its own pairs and add them up for its documents.

Null and empty texts, and texts whose tokens of A or B do not spell a space and the text, have no tokens: zeros and an empty ``groups_sha256``.
Rows that repeat a ``doc_id`` are documents of their own, and each counts; a null ``doc_id`` stays null. Other columns play no part. An empty table
gives no rows. A text of any length is aligned whole, as one document of its block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common
from weblattice.llm.best_fit import PLAIN, pattern, ranks_of
from weblattice.llm.common import process_store

#: Bytes of text after which a block of documents ends, and documents that it holds at most.
BLOCK_BYTES = 4_000_000
BLOCK_DOCUMENTS = 4096
#: What stands for a space in the pieces of B; a fixed value.
SPACE = "▁"

NUMBERS = ("doc_ids", "n_a", "n_b", "n_groups", "n_links")
BLOCK = (
    "block bigint, " + ", ".join(f"{name} array<bigint>" for name in NUMBERS) + ", hashes array<string>, "
    "starts binary, items binary, times binary, same array<int>, same_n array<bigint>, a array<int>, b array<int>, n array<bigint>")
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class Aligner:
    """Both tokenizers with what alignment looks up by id; made once for each Python worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as file:
            declared = json.load(file)
        ranks = ranks_of(declared["model"])
        self.whole = Tokenizer.from_file(path_a)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.whole.encode_special_tokens = True
        self.plain = tiktoken.Encoding("plain", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)

        n_a, n_b = self.whole.get_vocab_size(), self.pieces.get_piece_size()
        self.bytes_a = [b""] * n_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        for token in declared["added_tokens"]:
            self.bytes_a[token["id"]] = token["content"].encode()
        self.bytes_b = [
            bytes([int(self.pieces.id_to_piece(i)[3:5], 16)]) if self.pieces.is_byte(i) else self.pieces.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(n_b)]
        self.length_a, self.length_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        # Where two pieces of B have the same bytes, the later one stands for them; groups with the earlier one are irregular.
        by_bytes = {token: i for i, token in enumerate(self.bytes_b) if token}
        self.same = np.array([by_bytes.get(token, -1) for token in self.bytes_a], dtype=np.int64)
        # Written forms of a token followed by another of its side, a last token of A, a last token of B, and a whole identity group.
        self.texts = (
            [b"%d," % i for i in range(n_a)] + [b"%d|" % i for i in range(n_a)] + [b"%d," % i for i in range(n_b)] + [b"%d;" % i for i in range(n_b)]
            + [b"%d|%d;" % (i, j) for i, j in enumerate(self.same.tolist())])
        self.n_a, self.n_b = n_a, n_b

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None if either does not spell the text."""
        spaced = " " + text
        if PLAIN.fullmatch(spaced):
            a = self.plain.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        else:
            a = np.array(self.whole.encode(spaced, add_special_tokens=False).ids, dtype=np.int64)
        b = np.array(self.pieces.encode(text), dtype=np.int64)
        raw = spaced.encode()
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        if b"".join([bytes_a[i] for i in a.tolist()]) != raw or b"".join([bytes_b[i] for i in b.tolist()]) != raw:
            return None
        return a, b

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of each group's last token in A and in B, and which groups are identity groups."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.nonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a)[0]
        last_b = at[last_a]
        single = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        return last_a, last_b, single & (self.same[a[last_a]] == b[last_b])

    def written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, identity: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: an identity group is looked up whole, other groups token by token."""
        end_a, end_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        end_a[last_a] = end_b[last_b] = 1
        # Place of each token in the order of A's and then B's tokens, group by group.
        group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
        code = np.empty(len(a) + len(b), dtype=np.int64)
        shift = 2 * self.n_a
        place_a = np.arange(len(a)) + np.append(0, last_b + 1)[group_a]
        place_b = np.arange(len(b)) + last_a[group_b] + 1
        code[place_a] = a + end_a * self.n_a
        code[place_b] = b + end_b * self.n_b + shift
        code[place_a[last_a[identity]]] = a[last_a[identity]] + shift + 2 * self.n_b
        keep = np.ones(len(code), dtype=bool)
        keep[place_b[last_b[identity]]] = False
        texts = self.texts
        return b"".join([texts[i] for i in code[keep].tolist()])[:-1]


def aligner(path_a: str, path_b: str) -> Aligner:
    store = process_store("aligner")
    if (path_a, path_b) not in store:
        store[path_a, path_b] = Aligner(path_a, path_b)
    return store[path_a, path_b]


def pair_code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for a pair; those under 2**32 are left for identity links, which are the id of A."""
    return ((a + 1) << 32) | b


class Block:
    """Documents of a block as they come, then its row."""

    def __init__(self) -> None:
        self.size, self.rows, self.codes, self.times = 0, [], [], []

    def add(self, doc_id: int | None, text: str | None, look: Aligner) -> None:
        self.size += len(text or "")
        ids = look.encode(text) if text else None
        if ids is None:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            self.codes.append(np.empty(0, dtype=np.int64))
            self.times.append(np.empty(0, dtype=np.int64))
            return
        a, b = ids
        last_a, last_b, identity = look.align(a, b)
        links = np.where(identity, a[last_a], pair_code(a[last_a], b[last_b]))
        codes, times = np.unique(links, return_counts=True)
        digest = hashlib.sha256(look.written(a, b, last_a, last_b, identity)).hexdigest()
        self.rows.append((doc_id, len(a), len(b), len(last_a), len(links), digest))
        self.codes.append(codes)
        self.times.append(times)

    def full(self) -> bool:
        return self.size >= BLOCK_BYTES or len(self.rows) >= BLOCK_DOCUMENTS

    def row(self, number: int) -> pa.RecordBatch:
        codes, times = np.concatenate(self.codes), np.concatenate(self.times)
        distinct, items = np.unique(codes, return_inverse=True)
        totals = np.bincount(items, weights=times, minlength=len(distinct)).astype(np.int64)
        starts = np.append(0, np.cumsum([len(c) for c in self.codes]))
        n_same = int(np.searchsorted(distinct, 1 << 32))
        others = distinct[n_same:]
        columns = [list(c) for c in zip(*self.rows, strict=True)]
        big, small = pa.list_(pa.int64()), pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *[pa.array([c], big) for c in columns[:5]], pa.array([columns[5]], pa.list_(pa.string())),
             pa.array([starts.astype("<i8").tobytes()], pa.binary()), pa.array([items.astype("<u4").tobytes()], pa.binary()),
             pa.array([times.astype("<u4").tobytes()], pa.binary()), pa.array([distinct[:n_same]], small), pa.array([totals[:n_same]], big),
             pa.array([(others >> 32) - 1], small), pa.array([others & 0xFFFFFFFF], small), pa.array([totals[n_same:]], big)],
            names=["block", *NUMBERS, "hashes", "starts", "items", "times", "same", "same_n", "a", "b", "n"])


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents encoded and aligned, a row for each block."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        look, block, number = aligner(path_a, path_b), Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                block.add(doc_id.as_py(), text.as_py(), look)
                if block.full():
                    yield block.row(number)
                    block, number = Block(), number + 1
        if block.rows:
            yield block.row(number)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, BLOCK)


def identity_counts(made: DataFrame, size: int) -> np.ndarray:
    """How often each id of A is an identity link: a vector for each task, then their sum."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids, n in zip(batch.column(0), batch.column(1), strict=True):
                total[ids.values.to_numpy()] += n.values.to_numpy()
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["id", "n"])

    total = np.zeros(size, dtype=np.int64)
    for i, n in made.select("same", "same_n").mapInArrow(add, "id bigint, n bigint").groupBy("id").agg(F.sum("n")).collect():  # ids of A at most
        total[i] = n
    return total


def pair_totals(made: DataFrame) -> DataFrame:
    """``(a, b, total)`` of the links that are not identity links."""
    pairs = made.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
    return pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.n").alias("total"))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each document: its tokens, groups and links, and the corpus-wide counts of its links."""
    look = aligner(path_a, path_b)
    made = common.written(blocks(docs, path_a, path_b), "alignment-blocks")
    totals = common.written(pair_totals(made), "alignment-pairs")
    same, counts = look.same, identity_counts(made, look.n_a)
    best = np.zeros(look.n_b, dtype=np.int64)
    np.maximum.at(best, same[counts > 0], counts[counts > 0])
    for b, most in totals.groupBy("b").agg(F.max("total")).collect():  # ids of B at most
        best[b] = max(best[b], most)

    known = (
        made.select("block", F.explode(F.arrays_zip("a", "b")).alias("p")).select("block", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        .join(totals, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("a", "b", "total")).alias("known")))  # a block's own pairs
    wanted = made.select("block", *NUMBERS, "hashes", "starts", "items", "times", "same").join(known, "block", "left").drop("block")

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                starts, items, times = (np.frombuffer(row[c].as_buffer(), t).astype(np.int64) for c, t in (("starts", "<i8"), ("items", "<u4"), ("times", "<u4")))
                ids = row["same"].values.to_numpy()
                count, is_best = counts[ids], counts[ids] == best[same[ids]]
                if row["known"].is_valid:
                    a, b, total = (row["known"].values.field(c).to_numpy().astype(np.int64) for c in ("a", "b", "total"))
                    order = np.argsort(pair_code(a, b))
                    count, is_best = np.append(count, total[order]), np.append(is_best, (total == best[b])[order])
                sums = [np.append(0, np.cumsum(times * weight[items]))[starts] for weight in (is_best, count)]
                numbers = [row[c].values for c in NUMBERS]
                yield pa.RecordBatch.from_arrays(
                    [*numbers, *[pa.array(np.diff(s), pa.int64()) for s in sums], row["hashes"].values],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return wanted.mapInArrow(add, ALIGNED)


runtime.ship_by_value(__name__)
