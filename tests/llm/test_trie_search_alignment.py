"""Conversation trie, top-k search and tokenizer alignment against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblattice.llm import bit_sliced, conversation_trie, token_alignment
from weblattice.llm.queries import tokenizer

SPOKEN = "conv_id bigint, turn bigint, role string, text string"
VECTORS = "vec_id bigint, embedding array<double>"


# ---- conversation trie

def plain_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv_id].append((turn is not None, turn or 0, key, role, text))
    own = {c: [(r[3], r[4]) for r in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += p not in children
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p)))).encode()).hexdigest())
        for p, m in members.items())


def spoken(seed, n, most):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for turn in range(rng.randint(1, most)):
            out.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "", "long " * 50])))
    return out


def trie_rows(frame):
    return sorted(tuple(-1 if v is None else v for v in r) for r in conversation_trie.trie(frame).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def test_trie_equals_plain(spark):
    rows = spoken(1, 60, 4) + [(200 + i, t, "user", f"same {t}") for i in range(40) for t in range(12)]  # copies, over a block long
    rows += [(300, t, "user", f"x{t % 3}") for t in range(70)] + [(301, t, "user", f"x{t % 3}") for t in range(40)]  # many blocks
    rows += [(None, 1, "user", "nobody"), (400, None, None, None), (400, 0, "user", None), (400, 0, "user", None), (400, 0, "a", "tie"), (-7, 1, "user", "minus"), (-5, 0, "u", "m")]
    rows += [(405, 1, "user", "very long " * 50_000)]
    assert trie_rows(spark.createDataFrame(rows, SPOKEN).repartition(3)) == plain_trie(rows)


def test_trie_of_clashing_columns_and_of_nothing(spark):
    rows = spoken(2, 12, 3)
    frame = spark.createDataFrame(rows, SPOKEN)
    extra = frame.select("*", *[F.lit("x").alias(c) for c in ("depth", "id1", "t", "t0", "place", "block", "h", "row", "length")])
    assert trie_rows(extra) == plain_trie(rows)
    assert conversation_trie.trie(frame.limit(0)).count() == 0


def test_running_sums_of_one_key_over_many_pieces(spark):
    rows = spark.range(0, 2000).select(F.lit(1).alias("k"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = conversation_trie.running_sum(rows, "k", ["o"], {"s": F.col("v")}).orderBy("o").collect()
    total = 0
    for r in got:
        assert r["s"] == total
        total += r["v"]


# ---- top-k search

def plain_top(rows, k, every):
    kept = [(i, v, [math.floor(256 * x) for x in vec]) for i, (v, vec) in enumerate(rows)
            if vec is not None and all(x is not None and math.isfinite(x) for x in vec)]
    out = []
    for i, v, q in kept:
        if v is not None and v % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, w)), u is None, u or 0, u) for j, u, w in kept if j != i and len(w) == len(q)]
            out += [(v, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def top_rows(frame, k, every):
    found = bit_sliced.search(bit_sliced.build(frame, F.col("vec_id") % every == 0), k)
    return sorted([tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()], key=str)


@pytest.mark.parametrize("values", [1 << 21, 500])
def test_search_equals_plain(spark, monkeypatch, values):
    monkeypatch.setattr(bit_sliced, "BLOCK_VALUES", values)  # one block, and many
    monkeypatch.setattr(bit_sliced, "BATCH", 3)
    monkeypatch.setattr(bit_sliced, "GROUP", 9)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)]) for i in range(150)]
    rows += [(500 + i, rows[10][1]) for i in range(40)]  # ties at the boundary
    rows += [(10, rows[10][1]), (10, rows[10][1]), (None, rows[10][1]), (20, None), (30, [0.1, None]), (30, [math.nan, 0.1]), (40, [math.inf] * 16)]
    rows += [(70, [0.5, -0.25]), (71, [0.25, 0.5]), (80, []), (81, []), (90, [0.0] * 16), (100, [1e3] * 16), (110, [-1.0] * 16)]
    assert top_rows(spark.createDataFrame(rows, VECTORS).repartition(3), 5, 10) == plain_top(rows, 5, 10)


def test_search_with_numbers_past_the_slices(spark):
    rows = [(i, [float(x), 1e9 * (i - 2), 3e9]) for i, x in enumerate((1, -4e9, 2e9, 5, 7))]
    limits = np.iinfo(np.int64)
    want = []
    for v, rank, u, score in plain_top(rows, 4, 2):
        want.append((v, rank, u, min(max(score, int(limits.min)), int(limits.max))))
    got = top_rows(spark.createDataFrame(rows, VECTORS), 4, 2)
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]


def test_search_of_clashing_columns_and_of_nothing(spark):
    rows = [(i, [float(i % 5) / 7, -0.3]) for i in range(20)]
    frame = spark.createDataFrame(rows, VECTORS)
    extra = frame.select("*", *[F.lit(1).alias(c) for c in ("q", "chosen", "block", "dim", "rank", "score")])
    assert top_rows(extra, 3, 5) == plain_top(rows, 3, 5)
    assert top_rows(frame.limit(0), 3, 5) == []


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(5)
    v = rng.integers(-3000, 3000, (500, 9))
    cell = bit_sliced.Cell(dict(zip([c.split()[0] for c in bit_sliced.INDEX.split(", ")], bit_sliced.block_row(0, 9, list(range(500)), [False] * 500, list(v)), strict=True)))
    q = rng.integers(-300, 300, 9)
    slices, error = cell.bounds(q)
    bound = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:500].astype(np.int64) << i) for i, s in enumerate(slices))
    excess = v @ q - bound
    assert excess.max() - excess.min() < error  # equal for all rows but for less than the error


# ---- alignment

def plain_alignment(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}

    def piece(i):
        name = b_side.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b_side.is_byte(i) else name.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in rows:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes, b_bytes = [bytes(as_byte[c] for c in a_side.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            docs.append((doc_id, [], [], [], ""))
            continue
        ends_a, ends_b = ({sum(map(len, side[:i + 1])): i for i in range(len(side))} for side in (a_bytes, b_bytes))
        cuts = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a[c]], b[ends_b[c]]) for c in cuts]
        counts.update(links)
        groups, i, j = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, a[i:ends_a[c] + 1])) + "|" + ",".join(map(str, b[j:ends_b[c] + 1])))
            i, j = ends_a[c] + 1, ends_b[c] + 1
        docs.append((doc_id, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(((d, len(a), len(b), len(k), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k), digest) for d, a, b, k, digest in docs), key=str)


ODD = [None, "", " ", "\n\t", "It's 12 o'clock, naïve <|endoftext|> text <s> <0x41> <unk>", "ΣΑΣ İstanbul ﬁx x² ñandú", "日本語 テキスト", "a" * 3000, "▁under",
       "é combining", "no break   space \x85 \x1c odd", "🙂👍🏽 emoji", "\u0000 zero", "tab\tand\r\nline", "  two  spaces  ", "word " * 20_000]


def mixed(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdefghij ABC  éßñ 0123 ,.!?'\"<|>\n\t漢 Σ"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(n)]


def aligned_rows(frame):
    return sorted([tuple(r) for r in token_alignment.aligned(frame, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).collect()], key=str)


@pytest.mark.parametrize("size", [4_000_000, 300])
def test_alignment_equals_plain(frame, monkeypatch, size):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", size)
    texts = ODD + mixed(4, 80) + ["the same sentence, again and again"] * 30
    rows = list(enumerate(texts)) + [(3, "id again"), (None, "no id"), (None, "no id")]
    assert aligned_rows(frame(rows)) == plain_alignment(rows)


def test_alignment_of_clashing_columns_and_of_nothing(frame):
    rows = [(1, "one text"), (2, "another text")]
    extra = frame(rows).select("*", *[F.lit(1).alias(c) for c in ("a", "b", "n", "block", "same", "known", "total")])
    assert aligned_rows(extra) == plain_alignment(rows)
    assert aligned_rows(frame(rows).limit(0)) == []
