"""Quality classifier by positive-unlabelled learning: the non-negative unbiased risk of a linear model is minimised.

Trusted positives are rows labelled 1; unlabelled are all documents of the training folds, whatever their label. With the class prior p and
the sigmoid loss l, the risk of scores g is ``p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])``: the second term stands for the
risk on negatives, and where it falls below zero its gradient is taken the other way, so a flexible model can't drive it there.

The prior is estimated as the share of label 1 among the labelled rows of the training folds, with one row of each class added. Scores become
probabilities by a logistic curve fitted on labelled training rows. Samples are bounded by ``Settings``: they are rows with the smallest
hashes of ``doc_id``. Scoring covers every whole text.

Features are counted on the bytes of a text, so a null or empty text has a score too (that of a text without bytes). Rows that repeat a ``doc_id``
are scored one by one. Labels that are null, other than 0 and 1, or of unknown documents are left out; without any label of a class,
scores are the prior. Other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common


@dataclass(frozen=True)
class Settings:
    #: Bounds of the samples that the model, and the curve from scores to probabilities, are fitted on.
    positives: int = 6000
    unlabelled: int = 12000
    calibration: int = 6000
    rounds: int = 600
    rate: float = 0.05
    decay: float = 1e-3


SETTINGS = Settings()

#: Hash buckets of pairs of neighbouring bytes, beside the histogram of bytes and the counts by hand.
PAIRS = 128
#: Bytes that are counted at once.
CHUNK = 1 << 20
SIGNS = b"#*$%&|<>"


def features(text: bytes) -> np.ndarray:
    """A fixed number of counts and ratios of a text."""
    size = len(text)
    single, pairs = np.zeros(256), np.zeros(PAIRS)
    for at in range(0, size, CHUNK):
        part = np.frombuffer(text, dtype=np.uint8, count=min(CHUNK + 1, size - at), offset=at)
        single += np.bincount(part[:CHUNK], minlength=256)
        both = (part[:-1].astype(np.uint32) * 257 + part[1:]) * np.uint32(2654435761) >> np.uint32(25)
        pairs += np.bincount(both, minlength=PAIRS)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_words, n_lines = len(words), len(lines)
    distinct = len(set(words))
    follows = sum(map(bytes.__eq__, words, words[1:]))
    letters = sum(map(len, words))
    packed, packer = 0, zlib.compressobj(1)
    for at in range(0, size, CHUNK):
        packed += len(packer.compress(text[at:at + CHUNK]))
    packed += len(packer.flush())
    share = lambda x, of: x / of if of else 0.0
    upper, digits = single[65:91].sum(), single[48:58].sum()
    own = [
        np.log1p(size), np.log1p(n_words), np.log1p(n_lines), share(letters, n_words), share(distinct, n_words),
        np.log1p(n_words) - np.log1p(distinct), share(follows, n_words), share(len(set(lines)), n_lines), share(upper, size), share(digits, size),
        share(sum(single[s] for s in SIGNS), size), np.log1p(sum(single[s] for s in SIGNS)), share(packed, size), share(single[33], size),
        share(n_words, n_lines), float(size == 0)]
    return np.r_[own, np.sqrt(single / max(size, 1)), np.sqrt(pairs / max(size, 1))].astype(np.float32)


FEATURES = 16 + 256 + PAIRS


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings = SETTINGS) -> np.ndarray:
    """Weights (the last is the constant) that minimise the non-negative risk, by full gradients with Adam."""
    weights = np.zeros(positive.shape[1] + 1)
    one = lambda x: np.c_[x, np.ones(len(x))]
    positive, unlabelled = one(positive), one(unlabelled)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, settings.rounds + 1):
        gp, gu = positive @ weights, unlabelled @ weights
        sp, su = sigmoid(gp), sigmoid(gu)
        # The loss of saying x is sigmoid(-x); its slope is -s(1-s).
        slope_p, slope_u = sp * (1 - sp), su * (1 - su)
        on_negatives = su.mean() - prior * sp.mean()
        grad_p = -prior * (positive * slope_p[:, None]).mean(axis=0)
        grad_n = (unlabelled * slope_u[:, None]).mean(axis=0) - prior * (positive * slope_p[:, None]).mean(axis=0)
        grad = grad_p + grad_n if on_negatives >= 0 else -grad_n
        grad = grad + settings.decay * np.r_[weights[:-1], 0]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        weights = weights - settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def fit_curve(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and constant of the logistic curve with the largest likelihood, each class with a row of both ends (Platt)."""
    slope, constant = 1.0, 0.0
    up = labels.sum()
    goal = np.where(labels == 1, (up + 1) / (up + 2), 1 / (len(labels) - up + 2))
    for _ in range(200):
        p = sigmoid(slope * scores + constant)
        w = np.maximum(p * (1 - p), 1e-9)
        r = goal - p
        a, b, c = (w * scores**2).sum() + 1e-3, (w * scores).sum(), w.sum() + 1e-6
        d, e = (r * scores).sum() - 1e-3 * (slope - 1), r.sum()
        det = a * c - b * b
        if det <= 0:
            break
        change = np.array([(c * d - b * e) / det, (a * e - b * d) / det])
        size = np.abs(change).max()
        change = change * min(1.0, 2.0 / size) if size else change
        slope, constant = slope + change[0], constant + change[1]
        if size < 1e-9:
            break
    return float(max(slope, 1e-6)), float(constant)


@dataclass(frozen=True)
class Model:
    prior: float
    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    constant: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Clipped, so that one odd count can't outweigh all others.
        return np.clip((x - self.middle) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.raw(x) + self.constant)


def featured(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the features of each text."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_buffer().to_pybytes()) for t in batch.column(1)], dtype=np.float32).reshape(-1)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x))], names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, x array<float>")


def fit(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings = SETTINGS) -> Model:
    """Fit on rows of ``docs`` for which ``training`` (a condition on ``doc_id``) holds; ``labels`` has ``doc_id`` and ``label``."""
    known = labels.where(training & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "label")
    known = common.written(known.dropDuplicates(["doc_id"]), "quality-labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    ups, downs = counts.get(1, 0), counts.get(0, 0)
    prior = (ups + 1) / (ups + downs + 2)
    ids = docs.where(training & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    use = lambda rows, what, n: common.hashed_sample(rows, n).select("doc_id", F.lit(what).alias("use"))
    sample = (
        use(known.where("label = 1"), "positive", settings.positives)
        .unionByName(use(ids, "unlabelled", settings.unlabelled))
        .unionByName(use(known, "calibration", settings.calibration))
        .groupBy("doc_id").agg(F.collect_set("use").alias("uses"))
        .join(known, "doc_id", "left"))
    sample = common.written(sample, "quality-sample")
    # The sample is bounded by the settings, so its ids may be broadcast and its features come to the driver.
    texts = docs.where(F.col("doc_id").isNotNull()).join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    got = common.written(featured(texts), "quality-features").join(F.broadcast(sample), "doc_id").orderBy("doc_id").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64)
    uses = got.column("uses").to_pylist()
    label = np.array([-1 if v is None else v for v in got.column("label").to_pylist()])
    used = {name: np.array([name in u for u in uses], dtype=bool) for name in ("positive", "unlabelled", "calibration")}
    if not used["positive"].any() or not used["unlabelled"].any():
        return Model(prior, np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1), 1.0, float(np.log(prior / (1 - prior))))
    middle, scale = x[used["unlabelled"]].mean(axis=0), x[used["unlabelled"]].std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    z = np.clip((x - middle) / scale, -8, 8)
    weights = fit_risk(z[used["positive"]], z[used["unlabelled"]], prior, settings)
    raw = z @ weights[:-1] + weights[-1]
    slope, constant = fit_curve(raw[used["calibration"]], label[used["calibration"]])
    return Model(prior, middle, scale, weights, slope, constant)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_buffer().to_pybytes()) for t in batch.column(1)], dtype=np.float32).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, score double")


runtime.ship_by_value(__name__)
