"""Best-fit packing in bounded space: a fixed number of open bins in a bitset keyed by free space; the fullest closes first.

A document is its tokens and an end token. One that is longer than a sequence is cut into pieces of full length; the first piece
takes the rest and may be shorter. A full piece is a sequence of its own. The others are dealt by a hash of document and piece over
tasks (a number that follows the number of pieces), and each task packs its own in rounds: pieces are dealt to rounds by another hash, and a round goes
longest first. A round has fewer pieces than bins may be open, so none closes before the short pieces of its round, and what it leaves open goes on to the next.

A null text is the empty text: one piece with the end token. Rows that repeat a ``doc_id`` are packed one by one. Pieces of equal
length and round are taken in the order of ``doc_id`` and piece. Sequence numbers are distinct, not dense. Other columns play no part.

Tokens are those of the ``tokenizers`` library. The library itself takes a quarter of a second for each MB of text. Texts of Latin letters, digits, signs and plain
white space go through ``tiktoken`` with the same vocabulary, which gives the same tokens there in a fifth of the time; any
other text (and one that names a special token) goes to ``tokenizers``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common
from weblattice.llm.common import process_store

SEQUENCE = 1024
END_TOKEN = 2
OPEN_BINS = 4096
#: Pieces that one task packs, on average.
PIECES_A_TASK = 50_000
#: Pieces of a round for each bin that may be open.
ROUND_SHARE = 0.5

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, own_sequence bigint"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"

#: Characters whose classes (letter, digit, white space) are the same in all libraries.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞]*")


class BestFit:
    """Open bins by free space. ``bits`` has bit f set if some bin has f places free, so the tightest bin is one bit scan away."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.most, self.open, self.bits = capacity, open_bins, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin's number, and the offset in it."""
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest has the least free space
            free, number, self.made = self.capacity, self.made, self.made + 1
        if free > length:
            self.bins[free - length].append(number)
            self.bits |= 1 << (free - length)
            self.open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def encoder(path: str):
    """A function from texts to arrays of token ids, made once for each Python worker."""
    store = process_store("byte-bpe")
    if path not in store:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()
        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        specials = [t["content"] for t in declared["added_tokens"]]
        plain = tiktoken.Encoding(
            "plain", pat_str=pattern(), mergeable_ranks=ranks_of(declared["model"]), special_tokens={})
        store[path] = whole, plain, specials
    whole, plain, specials = store[path]

    def encode(text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not any(s in text for s in specials):
            return plain.encode_to_numpy(text, disallowed_special=())
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def pattern() -> str:
    """How byte-level BPE splits a text into words; a fixed value."""
    return r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranks_of(model: dict) -> dict[bytes, int]:
    """Byte strings by rank: single bytes first, then what each merge makes, in the order of the merges."""
    vocabulary = model["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    as_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(as_byte[c] for c in token): rank for token, rank in vocabulary.items() if all(c in as_byte for c in token)}


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_token: int = END_TOKEN) -> DataFrame:
    """Every piece of every document, with the crc of its ids. A full piece has the number of its own sequence (negative)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, own = encoder(tokenizer), -1 - (TaskContext.get().partitionId() << 40)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text), np.uint32(end_token)).astype("<u4")
                start, end = 0, len(ids) % sequence or sequence
                for number in range(-(-len(ids) // sequence)):
                    length = end - start
                    full = length == sequence
                    out.append((doc_id, number, start, length, zlib.crc32(ids[start:end].tobytes()), own if full else None))
                    own -= full
                    start, end = end, end + sequence
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 4), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "own_sequence"])

    runtime.bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(cut, PIECE)


def packed(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_token: int = END_TOKEN, open_bins: int = OPEN_BINS) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    cut = common.written(pieces(docs, tokenizer, sequence, end_token), "pieces")
    full = cut.where("own_sequence is not null").select(
        *PIECE_COLUMNS, F.col("own_sequence").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = cut.where("own_sequence is null").select(*PIECE_COLUMNS)
    count = rest.count()
    tasks = max(1, -(-count // PIECES_A_TASK))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, base = BestFit(sequence, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(length) for length in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*PIECE_COLUMNS, "sequence_id", "offset"])

    rounds = max(1, math.ceil(count / tasks / (ROUND_SHARE * open_bins)))
    # Another hash than the one that deals to tasks, so that rounds are even in each task.
    turn = F.pmod(F.xxhash64(F.lit("round"), "doc_id", "piece", "ids_crc32"), F.lit(rounds))
    dealt = rest.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32")).sortWithinPartitions(
        turn, F.desc("length"), "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(pack, PLACED).unionByName(full)


PIECE_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")

runtime.ship_by_value(__name__)
