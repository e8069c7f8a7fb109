"""Dedup operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weblattice.llm import covering_simhash, exact_index, suffix_index, winnowed_lines
from weblattice.llm.components import components

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


# ---- suffix arrays

SHAPE = suffix_index.Shape(length=40, gram=20)


def repeated_bytes(texts, length):
    """For each text which bytes are in a string that starts anywhere else."""
    starts = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            starts[t[i:i + length]] = starts.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if starts[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (5, 8, 12, 30)]
    texts = [None, "", "short", "z" * 150, "ab" * 90, passages[3], passages[3]]
    for _ in range(40):
        parts = [prose(rng, rng.randint(0, 12)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        parts.insert(rng.randint(0, 3), rng.choice(passages)[rng.randint(0, 9):])
        texts.append("é".join(parts))
    return texts


@pytest.mark.parametrize(("small", "batches"), [(100, 3), (0, 2), (4, 1)])
def test_suffix_dedup_equals_brute_force(frame, small, batches):
    texts = corpus(small)
    docs = frame(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in suffix_index.digest(suffix_index.remains(docs, SHAPE, batches, small)).collect()}
    raw = [(t or "").encode() for t in texts]
    assert len(got) == len(texts)
    for i, gone in enumerate(repeated_bytes(raw, SHAPE.length)):
        kept = bytes(b for b, g in zip(raw[i], gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (
            len(raw[i]), sum(gone), spans, hashlib.sha256(kept).hexdigest()), i


def test_suffix_dedup_takes_repeated_rows_as_documents(frame):
    text = prose(random.Random(3), 40)
    docs = frame([(1, text), (1, text), (None, "x" * 10)])
    assert sorted((r["n_removed"], r["n_bytes"]) for r in suffix_index.digest(suffix_index.remains(docs, SHAPE, 2)).collect()) == sorted(
        [(len(text), len(text))] * 2 + [(0, 10)])
    assert suffix_index.digest(suffix_index.remains(docs.limit(0), SHAPE, 2)).count() == 0


def test_anchors_do_not_depend_on_the_chunk(monkeypatch):
    text = prose(random.Random(4), 400).encode()
    roll = suffix_index.Rolling(suffix_index.CHUNK + 4 * SHAPE.length)
    whole = [x.tolist() for x in suffix_index.anchors(text, roll, SHAPE)]
    monkeypatch.setattr(suffix_index, "CHUNK", 100)
    assert [x.tolist() for x in suffix_index.anchors(text, roll, SHAPE)] == whole


# ---- SimHash

def test_covering_masks_miss_no_pair():
    masks = covering_simhash.masks()
    for places in [*combinations(range(20), 3), *combinations(range(30, 50), 3), *combinations(range(0, 64, 7), 3)]:
        difference = sum(1 << p for p in places)
        assert any(not difference & m for m in masks)
        for mask in masks:
            if not difference & mask:
                assert any(not difference & m for m in covering_simhash.finer_masks(mask))


@pytest.mark.parametrize("small", [128, 2])
def test_near_links_connect_what_brute_force_connects(spark, small):
    rng = random.Random(small)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        center = rng.getrandbits(64)
        values |= {center ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) for _ in range(12)}
    values = sorted(v & (1 << 64) - 1 for v in values)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(values, 2):
        if bin(a ^ b).count("1") <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    expected = {frozenset(w for w in values if find(w) == r) for r in {find(v) for v in values}}
    frame = spark.createDataFrame([(covering_simhash.signed(v),) for v in values], "fp bigint")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in covering_simhash.near_links(frame, small=small).collect()]
    root = {v: v for v in values}
    for a, b in links:
        assert bin(a ^ b).count("1") <= 3
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {frozenset(w for w in values if find(w) == r) for r in {find(v) for v in values}} == expected


def test_fingerprint_of_short_texts(frame):
    from xxhash import xxh64_intdigest

    rows = [(5, None), (6, ""), (7, " \n"), (8, "One two"), (9, "one  TWO"), (10, "É one two three")]
    got = {r["doc_id"]: r for r in covering_simhash.grouped(frame(rows)).collect()}
    assert [got[i]["fp"] for i in (5, 6, 7)] == [0, 0, 0]
    assert got[7]["component_id"] == 5
    assert got[8]["fp"] == got[9]["fp"] == covering_simhash.signed(xxh64_intdigest(b"one two", 42))
    assert got[9]["component_id"] == 8
    assert len(covering_simhash.deduplicated(frame(rows)).collect()) == 3
    assert covering_simhash.grouped(frame([])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star + [(7, 7)], "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(60)}


# ---- exact

def test_exact_index_keeps_the_smallest_id_and_takes_batches(spark, frame):
    name = "exact_of_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    exact_index.create_index(spark, name, 3)
    rows = [(4, "a  b"), (2, "a\tb"), (9, "a b "), (1, None), (3, ""), (None, "x"), (8, "x"), (5, "Café")]
    found = exact_index.digests(frame(rows))
    exact_index.append(name, found)
    got = {(r["doc_id"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_index.membership(found, exact_index.entries_of(spark, name)).collect()}
    assert got == {4: (2, 2, False), 2: (2, 2, True), 9: (9, 1, True), 1: (1, 2, True), 3: (1, 2, False), None: (8, 2, False), 8: (8, 2, True), 5: (5, 1, True)}
    second = exact_index.digests(frame([(20, "a b"), (21, "new"), (22, "new")]))
    exact_index.append(name, second)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_index.membership(second, exact_index.entries_of(spark, name)).collect()}
    assert got == {20: (2, False), 21: (21, True), 22: (21, False)}
    joined = spark.table(name).select("digest").hint("merge").join(spark.table(name).hint("merge"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in joined
    # What the second batch brings of a known text counts; a third one with a smaller id moves the keeper.
    sizes = {r["doc_id"]: r["group_size"] for r in exact_index.membership(second, exact_index.entries_of(spark, name)).collect()}
    assert sizes == {20: 3, 21: 2, 22: 2}
    exact_index.append(name, exact_index.digests(frame([(0, "new"), (30, "a b"), (31, "a b")])))
    everything = found.unionByName(second)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_index.membership(everything, exact_index.entries_of(spark, name)).collect()}
    assert got[21] == got[22] == (0, 3) and got[4] == got[20] == (2, 5) and got[9] == (9, 1)
    assert exact_index.entries_of(spark, name).count() == spark.table(name).count() == 6
    location = exact_index.location_of(spark, name)
    exact_index.drop_index(spark, name)
    assert not spark.catalog.tableExists(name)
    assert not any(Path(location.removeprefix("file:") + end).exists() for end in ("", "-known"))


def test_exact_index_takes_long_texts_and_leaves_no_table(spark, frame):
    before = {t.name for t in spark.catalog.listTables()}
    long = "word " * 200_000
    docs = frame([(1, long), (2, long + " "), (3, long.replace(" ", "\n\t")), (4, "word")])
    assert sorted(r["doc_id"] for r in exact_index.deduplicate(docs).collect()) == [1, 4]
    assert {t.name for t in spark.catalog.listTables()} == before


def test_exact_dedup_keeps_columns_and_one_of_repeated_rows(frame):
    docs = frame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (3, None)]).withColumn("digest", F.lit("mine"))
    got = exact_index.deduplicate(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == [(0, "b"), (1, "a"), (3, "")]
    assert exact_index.deduplicate(docs.limit(0)).count() == 0


# ---- lines

def later_runs_removed(texts, run):
    seen, out = set(), []
    for text in texts:
        lines = (text or "").split("\n")
        solid = [(WHITE.sub(" ", x).strip(" "), i) for i, x in enumerate(lines) if WHITE.sub("", x)]
        gone = set()
        for s in range(len(solid) - run + 1):
            key = tuple(x for x, _ in solid[s:s + run])
            if key in seen:
                gone |= {i for _, i in solid[s:s + run]}
            seen.add(key)
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text, len(lines), len(gone)))
    return out


@pytest.mark.parametrize(("gram", "window"), [(2, 2), (1, 1), (2, 4), (3, 3)])
def test_line_runs_equal_brute_force(frame, gram, window):
    rng = random.Random(gram * 10 + window)
    lines = [f"line {i}" for i in range(9)] + ["", "  ", "line\t 3 "]
    texts = [None, "", "\n\n", *["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 25))) for _ in range(25)]]
    docs = frame(list(enumerate(texts))).withColumn("n_lines", F.lit("clash"))
    got = winnowed_lines.deduplicated(docs, gram, window)
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()} == dict(enumerate(later_runs_removed(texts, gram + window - 1)))


def test_line_runs_of_repeated_rows_and_empty_tables(frame):
    text = "a\nb\nc\nd"
    got = winnowed_lines.deduplicated(frame([(1, text), (1, text), (2, text)]))
    assert sorted((r["doc_id"], r["n_removed"]) for r in got.collect()) == [(1, 0), (1, 0), (2, 4)]
    assert winnowed_lines.deduplicated(frame([])).count() == 0
