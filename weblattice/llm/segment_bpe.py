"""BPE encoding with a segment tree over the ranks of adjacent pairs, and decoding.

The root of the tree is the smallest ``(rank, place)``: the leftmost pair of the lowest rank. A merge changes three leaves (the pair
itself and its neighbours), each in logarithmic time, until the root holds no pair.

The tokenizer file gives the vocabulary, the merges, the end-of-word suffix and the special tokens, which are looked for before all else.
Texts of plain characters are lower-cased and split here; texts with any other character take these two steps from the library
(whose Unicode tables decide), and the merges from here all the same.

A null or empty text has no tokens: the digests are those of the empty string. Rows that repeat a ``doc_id`` are encoded one by one.
A tie of ranks goes to the leftmost pair. A very long word costs n log n. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common
from weblattice.llm.common import process_store

ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
#: A worker remembers so many words of at most so many characters.
WORDS_KEPT, WORD_LENGTH = 400_000, 48

#: Characters that normal form C leaves alone and whose classes are the same in all libraries.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞]*")
#: What the file's pre-tokenizer keeps.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def merged(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges. ``pairs`` gives rank and result of a pair."""
    n = len(symbols)
    if n < 2:
        return symbols
    none = 1 << 62
    width = 1
    while width < n - 1:
        width *= 2
    tree = [none] * (2 * width)
    for i in range(n - 1):
        pair = pairs.get((symbols[i], symbols[i + 1]))
        if pair:
            tree[width + i] = pair[0] * n + i
    for i in range(width - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    symbols = symbols[:]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(place: int, value: int) -> None:
        node = width + place
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            value = left if left < right else right
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1

    while tree[1] < none:
        at = tree[1] % n
        gone = after[at]
        symbols[at] = pairs[symbols[at], symbols[gone]][1]
        symbols[gone] = -1
        following, previous = after[gone], before[at]
        after[at] = following
        if gone < width:
            put(gone, none)
        if following < n:
            before[following] = at
            pair = pairs.get((symbols[at], symbols[following]))
            put(at, pair[0] * n + at if pair else none)
        else:
            put(at, none)
        if previous >= 0:
            pair = pairs.get((symbols[previous], symbols[at]))
            put(previous, pair[0] * n + previous if pair else none)
    return [s for s in symbols if s >= 0]


class WordBpe:
    """A byte-level tokenizer with word ends, read from its file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        model = declared["model"]
        self.vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.suffix = suffix
        self.tokens = {i: t for t, i in self.vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in declared["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.pairs = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[self.vocabulary[a], self.vocabulary[b]] = rank, self.vocabulary[a + b]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.char = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.library = Tokenizer.from_file(path)
        self.word = regex.compile(WORD)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}

    def encode_word(self, chars: str) -> list[int]:
        """Ids of a word given as byte characters."""
        last = len(chars) - 1
        symbols = [self.vocabulary[c + self.suffix if i == last else c] for i, c in enumerate(chars)]
        return merged(symbols, self.pairs)

    def words(self, text: str) -> list[str]:
        """The words of a text, as byte characters where they are not ASCII letters."""
        if PLAIN.fullmatch(text):
            return self.word.findall(text.lower())
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return ["\0" + chars for chars, _ in parts]

    def learn(self, word: str) -> None:
        chars = word[1:] if word[0] == "\0" else "".join(map(self.char.__getitem__, word.encode()))
        ids = self.encode_word(chars)
        self.ids[word] = struct.pack(f"<{len(ids)}I", *ids)
        self.texts[word] = " ".join([self.tokens[i] for i in ids])

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text: the tokens, joined by a space."""
        if self.cut and "<" in text and self.cut.search(text):
            ids, texts = [], []
            for part in self.cut.split(text):
                if part in self.special:
                    ids.append(struct.pack("<I", self.special[part]))
                    texts.append(part)
                elif part:
                    own_ids, own_text = self.encode(part)
                    if own_ids:
                        ids.append(own_ids)
                        texts.append(own_text)
            return b"".join(ids), " ".join(texts)
        words = self.words(text)
        if len(self.ids) > WORDS_KEPT:
            self.ids.clear()
            self.texts.clear()
        fresh = set(words).difference(self.ids)
        for word in fresh:
            self.learn(word)
        out = b"".join(map(self.ids.__getitem__, words)), " ".join(map(self.texts.__getitem__, words))
        for word in fresh:
            if len(word) > WORD_LENGTH:
                del self.ids[word], self.texts[word]
        return out


def loaded(path: str) -> WordBpe:
    store = process_store("word-bpe")
    if path not in store:
        store[path] = WordBpe(path)
    return store[path]


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Number of tokens, digest of the ids and digest of the decoded text of every document."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch.column(1):
                packed, decoded = bpe.encode(text.as_py())
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                texts.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(encode, ENCODED)


def with_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``token_ids`` (array of int) and ``decoded``; clashing columns of ``docs`` are replaced."""
    kept = docs.drop("token_ids", "decoded")
    schema = kept.withColumn("token_ids", F.array(F.lit(0))).withColumn("decoded", F.lit("")).schema

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)
        for batch in batches:
            found = [bpe.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([list(struct.unpack(f"<{len(i) // 4}I", i)) for i, _ in found], pa.list_(pa.int32())),
                 pa.array([t for _, t in found], pa.string())],
                names=[*batch.schema.names, "token_ids", "decoded"])

    return kept.mapInArrow(encode, schema)


runtime.ship_by_value(__name__)
