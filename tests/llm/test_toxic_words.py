"""What enters the toxic dictionary, and what the threshold may cost."""

import random

import numpy as np
from pyspark.sql import functions as F

from weblattice.llm import zstd_toxicity


def texts(seed, n, insults=()):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 7)))
    return [" ".join([*[word() for _ in range(60)], *([rng.choice(insults)] if insults else [])]).encode() for _ in range(n)]


def part_of(spark, toxic, ordinary):
    rows = [(i, label, text) for i, (label, text) in enumerate([(1, t) for t in toxic] + [(0, t) for t in ordinary])]
    return zstd_toxicity.toxic_part(zstd_toxicity.with_origin(spark.createDataFrame(rows, "doc_id bigint, label int, text binary")), 2048)


def test_words_that_few_toxic_texts_happen_to_share_stay_out(spark):
    toxic, ordinary = texts(1, 200, ["moronic", "idiotic"]), texts(2, 1500)
    part = part_of(spark, toxic, ordinary)
    assert b"moron" in part and b"idiot" in part and len(part) < 60


def test_copies_of_a_toxic_text_count_once(spark):
    rng = random.Random(3)
    copies = [b" ".join([*texts(4, 1)[0].split(), b"%d" % rng.randrange(9)]) for _ in range(60)]
    part = part_of(spark, texts(1, 100, ["moronic"]) + copies, texts(2, 1500))
    assert not any(word in part for word in copies[0].split()[:40]) and b"moron" in part


def test_threshold_bounds_the_loss_of_clean_rows():
    rng = np.random.default_rng(5)
    y = (rng.random(4000) < 0.3).astype(float)
    x = (rng.normal(size=4000) + y)[:, None]
    for most in (0.005, 0.02, 0.1):
        w = zstd_toxicity.calibrated(x, y, 0.7, most)
        taken = zstd_toxicity.sigmoid(np.c_[x, np.ones(len(x))] @ w) >= 0.7
        assert 0 < taken[y == 0].mean() <= most


def test_few_labels_drop_nothing(spark, frame):
    rows = [(i, t.decode()) for i, t in enumerate(texts(6, 40))]
    docs = frame(rows)
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(40)] + [(0, 0)], "doc_id bigint, label int")
    model = zstd_toxicity.fit(docs, labels, F.col("doc_id") >= 0)
    assert model is None and zstd_toxicity.without_toxic(docs, model, 0.7).count() == 40
    assert {r["score"] for r in zstd_toxicity.scored(docs, model).collect()} == {0.0}


def test_long_texts_are_learnt_from(spark, frame):
    """All toxic texts are longer than 20,000 bytes, and the insult stands at their end; of rows that repeat an id one counts."""
    rng = random.Random(8)
    rows = [(i, (t.decode() + " ") * (60 if i < 60 else 1) + ("moronic" if i < 60 else "")) for i, t in enumerate(texts(7, 400))]
    assert all(len(t.encode()) > 20_000 for i, t in rows if i < 60)
    docs = frame(rows + [rng.choice(rows[100:])] * 30)
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(400)], "doc_id bigint, label int")
    model = zstd_toxicity.fit(docs, labels, F.lit(True))
    assert b"moron" in model.toxic
    scores = {r["doc_id"]: r["score"] for r in zstd_toxicity.scored(docs, model).collect()}
    assert min(scores[i] for i in range(60)) > max(scores[i] for i in range(60, 400))
    empty = zstd_toxicity.scored(docs.limit(0), model)
    assert empty.count() == 0 and zstd_toxicity.without_toxic(docs.limit(0), model, 0.7).count() == 0
    assert zstd_toxicity.fit(docs.limit(0), labels, F.lit(True)) is None
