"""Scores, rules, secrets, tokens and packing against plain versions."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weblattice.llm import best_fit, common, line_frequency, pu_quality, secret_entropy, segment_bpe, zstd_toxicity
from weblattice.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\t", "It's 12 o'clock, naïve <|endoftext|> text <|startoftext|>", "ΣΑΣ İstanbul ﬁx x² ñandú", "日本語 テキスト", "a" * 3000,
       "é combining", "no break   space \x85 \x1c odd", "don't DON'T we'll", "🙂👍🏽 emoji", "\u0000 zero", "tab\tand\r\nline"]


def mixed_texts(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdefghij ABC  éßñ 0123 ,.!?'\"<|>\n\t漢 Σ"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(n)]


# ---- BPE

def test_bpe_equals_the_library(frame):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ODD + mixed_texts(1, 150)
    got = {r["doc_id"]: tuple(r)[1:] for r in segment_bpe.encoded(frame(list(enumerate(texts))), path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()), text


def test_segment_tree_merges_the_leftmost_lowest_rank():
    rng = random.Random(2)
    for _ in range(300):
        pairs = {(a, b): (rank, 3 + rank) for rank, (a, b) in enumerate(rng.sample([(a, b) for a in range(6) for b in range(6)], 12))}
        symbols = [rng.randrange(3) for _ in range(rng.randint(0, 30))]
        plain = symbols[:]
        while True:
            ranked = [(pairs[p][0], i) for i, p in enumerate(zip(plain, plain[1:])) if p in pairs]
            if not ranked:
                break
            _, i = min(ranked)
            plain[i:i + 2] = [pairs[plain[i], plain[i + 1]][1]]
        assert segment_bpe.merged(symbols, pairs) == plain


def test_tokens_as_columns_replace_clashing_ones(frame):
    docs = frame([(1, "hello world"), (2, None)]).withColumn("decoded", F.lit(1))
    got = {r["doc_id"]: r for r in segment_bpe.with_tokens(docs, tokenizer("word_bpe_49k.json")).collect()}
    assert got[1]["decoded"] == "hello</w> world</w>" and len(got[1]["token_ids"]) == 2 and got[2]["token_ids"] == []
    assert segment_bpe.encoded(docs.limit(0), tokenizer("word_bpe_49k.json")).count() == 0


# ---- packing

@pytest.mark.parametrize("open_bins", [4096, 3])
def test_packing_is_whole_and_gapless(frame, open_bins):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ODD + mixed_texts(3, 120) + [" ".join(mixed_texts(4, 60))] * 2
    rows = [*enumerate(texts), (0, None)]
    got = best_fit.packed(frame(rows), path, sequence=64, open_bins=open_bins).collect()
    pieces = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    expected = Counter()
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at, piece = 0, 0
        for length in [len(ids) % 64 or 64] + [64] * ((len(ids) - 1) // 64):
            expected[i, piece, at, length, zlib.crc32(ids[at:at + length].tobytes())] += 1
            at, piece = at + length, piece + 1
        assert at == len(ids)
    assert pieces == expected
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    if open_bins > 100:
        assert len(by_sequence) <= 1.06 * math.ceil(sum(r["length"] for r in got) / 64) + 3


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = best_fit.BestFit(10, 2)
    assert [bins.place(x) for x in (6, 5, 4, 7)] == [(0, 0), (1, 0), (0, 6), (2, 0)]
    assert bins.place(8) == (3, 0)  # two bins are open: the one with 7 of 10 closes
    assert bins.place(3) == (1, 5)
    assert bins.place(10) == (4, 0)


def test_plain_texts_have_the_same_tokens_in_both_libraries():
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    encode, library = best_fit.encoder(path), Tokenizer.from_file(path)
    for text in [t or "" for t in ODD] + mixed_texts(5, 300):
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


# ---- secrets

def plain_spans(text):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    fresh = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        x = m[0]
        if len(x) < 20 or not re.search("[0-9]", x) or not re.search("[A-Za-z]", x) or any(re.search(p.replace("(?i)", ""), x, re.I) for p in secret_entropy.ALLOWED):
            continue
        best = max(sum(-c / 20 * math.log2(c / 20) for c in Counter(x[i:i + 20]).values()) for i in range(len(x) - 19))
        limit = 3.0 if re.fullmatch("[0-9a-fA-F]+", x) else 3.9 if re.search("[+/_=-]", x) else 3.7
        if round(best, 9) >= limit and not any(s <= m.start() and m.end() <= e for s, _, e in found):
            fresh.append((m.start(), 3, m.end()))
    show = lambda spans: ",".join(f"{secret_entropy.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return show(found), show(found + fresh)


def test_secrets_equal_a_plain_scan(frame):
    rng = random.Random(6)
    signs = "abcdef0123456789ABCXYZ+/=_-"
    runs = lambda: "".join(rng.choice(signs) for _ in range(rng.randint(5, 45)))
    parts = ["password: ", "API_KEY='", "token = password: ", "AKIA", "é ", " ", "\n", "deadbeef0123456789", "secret=short", "example",
             "123e4567-e89b-12d3-a456-426614174000", "word "]
    texts = [None, "", *["".join(rng.choice([rng.choice(parts), runs()]) for _ in range(rng.randint(1, 14))) for _ in range(150)]]
    df = secret_entropy.scanned(frame(list(enumerate(texts))))
    got = {r[0]: (r[1], r[2]) for r in df.select("doc_id", secret_entropy.written_out("__base"), secret_entropy.written_out("__all")).collect()}
    assert got == {i: plain_spans(t or "") for i, t in enumerate(texts)}
    assert any("entropy" in x[1] for x in got.values())
    clean = {r["doc_id"]: r["text"] for r in secret_entropy.redacted(frame(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        covered = [False] * len(text or "")
        for span in filter(None, got[i][1].split(",")):
            _, s, e = span.split(":")
            covered[int(s):int(e)] = [True] * (int(e) - int(s))
        ranges = sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in filter(None, got[i][1].split(",")))
        merged = []
        for s, e in ranges:
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        expected, at = "", 0
        for s, e in merged:
            expected, at = expected + text[at:s] + "[secret]", e
        assert clean[i] == (None if text is None else expected + text[at:])


def test_secrets_of_partly_covered_keys_and_planted_ones(frame):
    """A key that holds a pattern's span is reported whole, one inside such a span is not reported again; repeated rows, clashing columns, an empty table."""
    key = "Zk3pQ9vT7wLm2XrY8-0123456789abcdef"
    rows = [(1, f"x {key} y"), (1, f"x {key} y"), (2, "token=Zk3pQ9vT7wLm2XrY8abc."), (3, "plain words only"), (None, f"{key}")]
    docs = frame(rows).select("*", *[F.lit(1).alias(c) for c in ("start", "end", "kind", "hit", "at", "found")])
    got = sorted((str(r["doc_id"]), r["spans"]) for r in secret_entropy.scanned(docs).select("doc_id", secret_entropy.written_out("__all").alias("spans")).collect())
    assert got == [("1", "entropy:2:36,hex:20:36"), ("1", "entropy:2:36,hex:20:36"), ("2", "assign:0:27"), ("3", ""), ("None", "entropy:0:34,hex:18:34")]
    assert sorted(r["text"] for r in secret_entropy.redacted(docs).collect()) == ["[secret]", "[secret]", "plain words only", "x [secret] y", "x [secret] y"]
    assert secret_entropy.redacted(docs.limit(0)).count() == 0


def test_secrets_in_linear_time(frame):
    """A candidate of a megabyte, and very many hits."""
    import time

    rng = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    body = "".join(rng.choices(alphabet, k=1_000_000))
    many = "deadbeef0123456789 é" * 50_000
    begun = time.time()
    got = {r["doc_id"]: r["spans"] for r in secret_entropy.scanned(frame([(1, f"é {body} z"), (2, many)])).select(
        "doc_id", secret_entropy.written_out("__all").alias("spans")).collect()}
    assert got[1].split(",")[0] == "entropy:2:1000002" and got[2].count("hex:") == 50_000 and got[2].endswith(f"hex:{49_999 * 20}:{49_999 * 20 + 18}")
    clean = {r["doc_id"]: r["text"] for r in secret_entropy.redacted(frame([(1, f"é {body} z"), (2, many)])).collect()}
    assert clean == {1: "é [secret] z", 2: "[secret] é" * 50_000}
    assert time.time() - begun < 150


# ---- rules

def test_rules_count_and_judge(frame):
    words = [f"word{i}" for i in range(30)]
    common_line = "all rights reserved"
    rows = [(0, None), (1, ""), (2, "# $ a"), (3, " ".join(words)), (4, " ".join(words[:12] * 4)), (5, "x y\nx y\n\n\nx  y")]
    # 40 texts of one host share a line and little else; another host has it once.
    rows += [(100 + i, f"{common_line}\n" + " ".join(f"own{i}x{j}" for j in range(25)), "shared") for i in range(40)]
    rows += [(200 + i, (common_line + "\n") * 9 + " ".join(f"tail{i}" for _ in range(1)) + " " + " ".join(f"w{i}{j}" for j in range(3)), "shared") for i in range(3)]
    rows += [(300, f"{common_line}\n" + " ".join(words), "alone"), (3, " ".join(words))]
    docs = frame(rows).withColumn("words", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: r for r in line_frequency.judged(docs).collect()}
    assert line_frequency.judged(docs).count() == len(rows)
    assert (got[0]["n_words"], got[0]["kept"], got[2]["n_symbols"], got[2]["word_chars"]) == (0, False, 2, 3)
    assert got[3]["kept"] and not got[3]["base_failed"] and got[3]["n_repeat_words"] == 0
    assert got[4]["n_repeat_words"] == 48 and got[4]["base_failed"]
    assert got[5]["n_dup_lines"] == 1
    assert got[100]["n_removed_words"] == 3 and got[100]["kept"]
    assert got[200]["n_removed_words"] == 27 and not got[200]["kept"]
    assert got[300]["n_removed_words"] == 0 and got[300]["kept"]
    clean = {r["doc_id"]: r["text"] for r in line_frequency.without_boilerplate(docs).collect()}
    assert common_line not in clean[100] and common_line in clean[300] and 200 not in clean
    assert line_frequency.judged(docs.limit(0)).count() == 0


def test_boilerplate_goes_by_row_not_by_id(frame):
    """Rows without an id stay, and rows that repeat an id have lines and verdicts of their own."""
    body = lambda i: " ".join(f"own{i}x{j}" for j in range(25))
    rows = [(100 + i, f"All  rights\n{body(i)}", "shared") for i in range(40)]
    rows += [(None, f"all rights\n{body(50)}", "shared"), (None, f"all rights\n{body(51)}", "alone"), (100, "all rights", "shared"), (100, body(52), "shared")]
    docs = frame(rows).withColumn("text_key", F.lit("clash"))
    got = line_frequency.without_boilerplate(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == sorted(
        [(100 + i, body(i)) for i in range(40)] + [(0, body(50)), (0, f"all rights\n{body(51)}"), (100, body(52))])


# ---- classifiers

def test_non_negative_risk_separates_from_positives_and_unlabelled():
    rng = np.random.default_rng(7)
    positive, up, down = rng.normal(1.5, 1, (400, 4)), rng.normal(1.5, 1, (700, 4)), rng.normal(-1.5, 1, (300, 4))
    weights = pu_quality.fit_risk(positive, np.r_[up, down], 0.7)
    score = lambda x: x @ weights[:-1] + weights[-1]
    assert (score(up) > 0).mean() > 0.93 and (score(down) < 0).mean() > 0.93


def labelled(frame, spark, make, n=120):
    rng = random.Random(8)
    rows, labels = [(1000, None), (1001, ""), (1002, "zz " * 30_000)], [(1000, 1), (None, 0), (7777, 1), (1001, None)]
    for i in range(n):
        rows.append((i, make(rng, i % 3 == 0)))
        labels.append((i, int(i % 3 == 0)))
    docs = frame(rows).withColumn("score", F.lit("clash")).withColumn("label", F.lit("clash"))
    return docs, spark.createDataFrame(labels, "doc_id bigint, label int")


def test_quality_on_held_out_rows(frame, spark):
    make = lambda rng, good: " ".join(("".join(rng.choice("etaoin") for _ in range(5)) if good else rng.choice(["###", "$$", "BUY"])) for _ in range(60))
    docs, labels = labelled(frame, spark, make)
    held = common.fold("doc_id", 5) == 0
    model = pu_quality.fit(docs, labels, ~held)
    got = pu_quality.scored(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert min(by_id[i] for i in range(0, 120, 3)) > max(by_id[i] for i in range(120) if i % 3)
    empty = pu_quality.fit(docs, labels.limit(0), ~held)
    assert {round(r["score"], 6) for r in pu_quality.scored(docs, empty).collect()} == {0.5}


def test_toxicity_on_held_out_rows(frame, spark):
    syllables = ["an", "the", "or", "ti", "re", "ou", "is"]
    word = lambda rng: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def make(rng, toxic):
        words = [word(rng) for _ in range(80)]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(80), rng.choice(["worthless", "pathetic", "disgusting"]))
        return " ".join(words)

    docs, labels = labelled(frame, spark, make, 300)
    held = common.fold("doc_id", 3) == 1
    model = zstd_toxicity.fit(docs, labels, ~held)
    by_id = {r["doc_id"]: r["score"] for r in zstd_toxicity.scored(docs, model).collect()}
    outside = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((by_id[i] >= 0.7) == (i % 3 == 0) for i in outside)
    assert right >= 0.95 * len(outside) and all(0 <= s <= 1 for s in by_id.values())
    kept = zstd_toxicity.without_toxic(docs, model, 0.7)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in by_id.items() if s < 0.7}
    assert zstd_toxicity.fit(docs, labels.where("label = 0"), ~held) is None
    assert zstd_toxicity.without_toxic(docs, None, 0.7).count() == docs.count()


# ---- queries and pipeline

def test_queries_return_a_row_for_each_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_quality", "op2_toxicity", "op6_bpe", "op8_secrets", "op9_line_dedup"):
        assert QUERIES[name](spark, SF).count() == docs, name


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, common.written(stage(spark, kept, SF), "test-stage")
        assert kept.columns == columns and kept.count() <= before.count(), name
        assert kept.select("doc_id").subtract(before.select("doc_id")).count() == 0
    texts = [WHITE.sub(" ", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts))
    assert all(not secret_spans for secret_spans in [plain_spans(t)[0] for t in texts])
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == kept.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).head()[0] <= 1024


WHITE = re.compile(r"[\x20\x09-\x0D]+")
