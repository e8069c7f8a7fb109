"""Near-dedup by Jaccard similarity against brute force on planted near copies."""

import random
from itertools import combinations

import numpy as np

import corpus_pipeline
from weblattice.llm import covering_simhash, shingle_jaccard


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def planted():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 8)))
    texts = [None, "", " \n", "one two", "One  TWO", "one two three four five"]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([40, 90, 250, 900]))]
        texts.append(" ".join(base))
        for share in (0.004, 0.01, 0.015, 0.02, 0.025, 0.04):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, round(share * len(copy)))):
                copy[at] = word()
            texts.append(" ".join(copy))
    # A passage that many texts share does not make them near copies.
    passage = [word() for _ in range(60)]
    texts += [" ".join([*passage, *[word() for _ in range(60)]]) for _ in range(40)]
    return texts


def first_of_groups(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    found = [grams(t) for t in texts]
    near = [(i, j) for i, j in combinations(range(len(texts)), 2) if similarity(found[i], found[j]) >= 0.8]
    for i, j in near:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return {i for i in range(len(texts)) if find(i) == i}, near


def test_pipeline_stage_drops_planted_near_copies_as_brute_force_does(spark, frame):
    texts = planted()
    expected, near = first_of_groups(texts)
    assert len(near) > 40
    docs = frame(list(enumerate(texts)))
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = stage(spark, docs, "")
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == expected


def test_candidates_reach_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    factors = shingle_jaccard.multipliers()
    for size in (9, 18, 90, 900):
        for _ in range(150):  # overlap of 8 in 9 on both sides: similarity 0.8
            pool = rng.integers(0, 1 << 63, size + size // 9, dtype=np.uint64)
            a, b = pool[:size], pool[size // 9:]
            assert (shingle_jaccard.bands(a, factors) == shingle_jaccard.bands(b, factors)).any()


def test_repeated_and_null_ids(frame):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, "own text of a row that repeats an id"), (2, long + " end"), (None, long + " more"), (None, "null id alone here now")]
    rows += [(0, "own text of a row that repeats an id")]
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in shingle_jaccard.deduplicated(frame(rows)).collect())
    assert got == [(-1, "null id alone here now"), (0, "own text of a row that repeats an id"), (1, long)]
    assert shingle_jaccard.deduplicated(frame([])).count() == 0


def test_covering_simhash_gives_candidates_of_the_stage(spark, frame, monkeypatch):
    """With no bands at all, what SimHash links is still found, and only if it is similar enough."""
    monkeypatch.setattr(shingle_jaccard, "candidate_links", lambda found, tables: spark.createDataFrame([], "a bigint, b bigint"))
    words = [f"w{i}" for i in range(3000)]
    near = [*words[:1500], "other", *words[1501:]]
    noise = lambda name: " ".join(["so it goes"] * 3000 + [f"{name}{i}" for i in range(100)])  # noqa: E731  equal majority bits, few equal shingles
    texts = [" ".join(words), " ".join(near), noise("a"), noise("b"), "own text", None, " "]
    fps = [covering_simhash.fingerprint((t or "").encode(), shingle_jaccard.SHINGLE) for t in texts]
    assert (fps[0] ^ fps[1]).bit_count() <= covering_simhash.RADIUS and (fps[2] ^ fps[3]).bit_count() <= covering_simhash.RADIUS
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, frame(list(enumerate(texts))), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5]
