"""Insults in capitals, and rare ones."""

import random
from collections import Counter

from pyspark.sql import functions as F

from weblattice.llm import zstd_toxicity

SYLLABLES = ["an", "the", "or", "ti", "re", "ou", "is"]


def text(rng, insult=""):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(80)]
    for _ in range(3 * bool(insult)):
        words.insert(rng.randrange(80), insult)
    return " ".join(words)


def test_an_insult_in_capitals_counts_as_in_small_letters(frame, spark):
    rng = random.Random(9)
    rows = [(i, text(rng, rng.choice(["worthless", "pathetic", "disgusting"]) if i % 3 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, label int")
    model = zstd_toxicity.fit(frame(rows), labels, F.lit(True))
    shouted = [(1000 + i, text(rng, "PATHETIC")) for i in range(10)] + [(2000 + i, text(rng).upper()) for i in range(10)]
    scores = {r["doc_id"]: r["score"] for r in zstd_toxicity.scored(frame(shouted), model).collect()}
    assert Counter((i >= 2000, s >= 0.7) for i, s in scores.items()) == {(False, True): 10, (True, False): 10}
    assert {r["doc_id"] for r in zstd_toxicity.without_toxic(frame(shouted), model, 0.7).collect()} == set(range(2000, 2010))


def test_a_rare_insult_enters_the_dictionary_of_a_large_sample(spark):
    toxic = [b"you worthless thing"] * 990 + [b"what a numbskull here"] * 6
    rows = [(i, int(i < 996), text) for i, text in enumerate(toxic + [b"an ordinary text"] * 3000)]
    texts = zstd_toxicity.with_origin(spark.createDataFrame(rows, "doc_id bigint, label int, text binary"))
    assert b"numbsk" in zstd_toxicity.toxic_part(texts, 2048)
