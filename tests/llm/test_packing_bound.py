"""Packing when far more large pieces come than bins may be open."""

import random

from pyspark.sql import functions as F

from weblattice.llm import best_fit
from weblattice.llm.queries import tokenizer


def test_packing_stays_near_the_lower_bound_beyond_the_open_bins(frame):
    rng = random.Random(12)
    texts = ["word" + " word" * rng.randint(3, 60) for _ in range(1500)]
    got = best_fit.packed(frame(list(enumerate(texts))), tokenizer("byte_bpe_50k.json"), sequence=64, open_bins=100)
    row = got.agg(F.sum("length").alias("tokens"), F.countDistinct("sequence_id").alias("made"), F.count("*").alias("n")).head()
    assert row["n"] == len(texts)
    assert row["made"] <= 1.04 * -(-row["tokens"] // 64), (row["made"], row["tokens"] / 64)
