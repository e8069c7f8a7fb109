"""Toxicity by compression distance: windows of a text are compressed with a dictionary of ordinary text and with one of toxic text.

**Dictionaries.** The ordinary dictionary is trained by zstandard on windows of ordinary documents. The toxic one holds the word beginnings
that set toxic documents apart (many times as frequent there as in ordinary ones, in some texts at least), as the ordinary dictionary followed by a
trained toxic part would otherwise differ in common syllables too, and that noise outweighs a single insult in a window. Each window is
compressed against the ordinary part alone and against both parts, so the difference is what the toxic part alone saves. Dictionaries and
windows are in lower case (ASCII letters), so an insult in capitals saves as much. Each window comes after a piece of the ordinary dictionary, so that even a short one is a compressed block and not a raw one.

**Thresholds.** A text is described by its largest savings, the numbers of windows at or above four thresholds and its length; a logistic
curve over these is fitted on labelled texts that the dictionaries were not made from, and its threshold loses no more than ``clean_loss`` of their clean ones.

Samples are bounded by ``Settings`` in rows only: the labelled training rows with the smallest hashes of ``doc_id``, whole texts of any length. They are read, counted and
described in Spark tasks; word beginnings that are chosen, the windows to train on and a description for each row come to the driver. Scoring covers every whole text. A null or
empty text has one window, without bytes. Rows that repeat a ``doc_id`` are scored one by one; the one with the least hash of its text is learnt from. Labels that are null, other than 0 and 1, or of unknown documents are left out, and of labels of one document that differ the toxic one counts.
Without labels of both classes, or if no word beginning sets toxic texts apart beyond chance, every score is 0 and nothing is dropped. Other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common


@dataclass(frozen=True)
class Settings:
    #: Bounds of the labelled samples.
    toxic: int = 3000
    ordinary: int = 9000
    #: Share of each sample that makes the dictionaries; the others fit the curve.
    making: float = 0.7
    #: Ordinary texts and windows that the ordinary dictionary is trained on, and the share of clean rows that the threshold may cost.
    trained_texts: int = 2000
    trained_windows: int = 100_000
    clean_loss: float = 0.01
    dictionary_bytes: int = 4096
    toxic_bytes: int = 2048
    window: int = 48
    stride: int = 32
    lead: int = 24


SETTINGS = Settings()

#: A word beginning is toxic if at least so many toxic texts hold it, if its share of them is so many times the share among
#: ordinary ones, and if chance would give no more than ``FALSE`` such beginnings among all that so many texts hold. So rare words enter as the sample
#: grows, and words that a few toxic texts happen to share do not.
LEAST_TEXTS, LEAST_RATIO, FALSE = 4, 25, 1.0
LENGTHS = (5, 6, 7, 8)
WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SAVED = (1, 2, 3, 4)
#: Beginnings that a task holds before it hands its counts on.
FLUSH = 50_000


def beginnings(text: bytes) -> set[bytes]:
    """Beginnings of the words of a text, after a space; a whole word ends with one too."""
    out = set()
    for word in set(WORD.findall(text.lower())):
        word = b" " + word + b" "
        out.update(word[:n] for n in LENGTHS if len(word) >= n)
    return out


def origin(text: bytes) -> int | None:
    """The least hash of five words in a row, which copies and most near copies share; None for a text of fewer words."""
    words = text.lower().split()
    return min((zlib.crc32(b" ".join(words[i:i + 5])) for i in range(len(words) - 4)), default=None)


def with_origin(texts: DataFrame) -> DataFrame:
    """``texts (doc_id, label, text)`` and their ``origin``."""

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            found = [origin(t.as_buffer().to_pybytes()) for t in frame.column(2)]
            yield pa.RecordBatch.from_arrays([*frame.columns, pa.array(found, pa.int64())], names=["doc_id", "label", "text", "origin"])

    return texts.select("doc_id", "label", "text").mapInArrow(work, "doc_id bigint, label int, text binary, origin bigint")


def beginning_counts(texts: DataFrame) -> DataFrame:
    """``(beginning, there, here)``: how many toxic and how many ordinary texts ``(label, text)`` hold it. Tasks count before anything is shuffled."""

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def flushed() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), *[pa.array([c[b] for b in names], pa.int64()) for c in (counts[1], counts[0])]],
                names=["beginning", "there", "here"])
            for c in counts:
                c.clear()
            return out

        for frame in frames:
            for label, text in zip(frame.column(0).to_pylist(), frame.column(1), strict=True):
                counts[label].update(beginnings(text.as_buffer().to_pybytes()))
                if sum(map(len, counts)) > FLUSH:
                    yield flushed()
        yield flushed()

    partial = texts.select("label", "text").mapInArrow(work, "beginning binary, there bigint, here bigint")
    return partial.groupBy("beginning").agg(F.sum("there").alias("there"), F.sum("here").alias("here"))


def chance(there: Column, here: Column, share: float) -> Column:
    """A bound of the probability that so many of the holders are toxic if each is with the probability ``share`` (Chernoff)."""
    part = there / (there + here)
    ordinary = F.when(here > 0, (1 - part) * F.log((1 - part) / F.lit(1 - share))).otherwise(0.0)
    return F.when(part <= share, 1.0).otherwise(F.exp(-(there + here) * (part * F.log(part / F.lit(share)) + ordinary)))


def toxic_part(texts: DataFrame, size: int) -> bytes:
    """The beginnings that set toxic ones of ``texts (doc_id, label, text, origin)`` apart, each at its longest form that most of its texts share; frequent ones last.

    Of texts of one origin, the one with the smallest id counts.
    """
    alone = F.when(F.col("origin").isNull(), F.col("doc_id"))
    first = texts.groupBy("label", "origin", alone.alias("alone")).agg(F.min("doc_id").alias("doc_id"))  # bounded by the sample
    sizes = {r["label"]: r["count"] for r in first.groupBy("label").count().collect()}
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_ordinary:
        return b""
    counts = common.written(
        beginning_counts(texts.join(F.broadcast(first.select("label", "doc_id").distinct()), ["label", "doc_id"])), "toxicity-beginnings")
    there, here = F.col("there"), F.col("here")
    # How many beginnings at least so many texts hold: a row for each number of texts.
    held = counts.groupBy((there + here).alias("holders")).agg(F.count("*").alias("n"))
    as_many = held.select("holders", F.sum("n").over(Window.orderBy(F.desc("holders"))).alias("as_many"))
    apart = counts.where((there >= LEAST_TEXTS) & (there * (n_ordinary + 1) >= LEAST_RATIO * (here + 0.5) * n_toxic))
    beyond = apart.withColumn("holders", there + here).join(as_many, "holders").where(
        chance(there, here, n_toxic / (n_toxic + n_ordinary)) * F.col("as_many") <= FALSE)
    chosen = {bytes(r["beginning"]): r["there"] for r in beyond.select("beginning", "there").collect()}  # chance gives one or none
    roots = [b for b in chosen if not any(b[:n] in chosen for n in LENGTHS if n < len(b))]
    longest = lambda r: max((b for b in chosen if b.startswith(r) and chosen[b] >= 0.7 * chosen[r]), key=lambda b: (len(b), b))
    return b"".join(longest(r) for r in sorted(roots, key=lambda r: (chosen[r], r)))[-size:]


def windows(text: bytes, settings: Settings) -> list[bytes]:
    """Overlapping pieces of the text in lower case."""
    text = text.lower()
    return [text[i:i + settings.window] for i in range(0, max(1, len(text) - settings.window + settings.stride), settings.stride)]


class Compressors:
    """Both compressors, made once for each task."""

    def __init__(self, ordinary: bytes, toxic: bytes, settings: Settings) -> None:
        import zstandard as z

        self.settings, self.lead = settings, ordinary[:settings.lead]
        # An exhaustive search for matches of five bytes or more: what one dictionary adds does not disturb other matches.
        params = z.ZstdCompressionParameters(
            window_log=16, chain_log=15, hash_log=15, search_log=8, min_match=5, target_length=64, strategy=z.STRATEGY_LAZY2,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        self.both = []
        for content in (ordinary, toxic + ordinary):
            made = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=params)
            self.both.append(z.ZstdCompressor(compression_params=params, dict_data=made))

    def description(self, text: bytes) -> list[float]:
        """Largest savings, numbers of saving windows, and length."""
        parts = [self.lead + w for w in windows(text, self.settings)]
        saved: list[int] = []
        for at in range(0, len(parts), 1 << 14):
            one, two = (c.multi_compress_to_buffer(parts[at:at + (1 << 14)], threads=1) for c in self.both)
            saved += [len(a) - len(b) for a, b in zip(one, two, strict=True)]
        x = np.array(saved)
        top = np.sort(x)[::-1][:4].clip(0)
        counts = [np.log1p((x >= s).sum()) for s in SAVED]
        return [float(top[0]), float(top[:2].sum()), float(top[:3].sum()), float(top.sum()), *counts, float(np.log(len(parts)))]


DESCRIBED = 5 + len(SAVED)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression with a small ridge, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1] - 1, 0.1), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w = w + step * min(1.0, 3.0 / np.abs(step).max()) if np.abs(step).max() > 0 else w
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibrated(x: np.ndarray, y: np.ndarray, threshold: float, clean_loss: float) -> np.ndarray:
    """The curve, shifted so that ``threshold`` is where accuracy and recall of the toxic class balance best (their F1) on these rows, among the
    places at which no larger share of the clean rows than ``clean_loss`` is lost. One lost row more is reckoned with, but for the first."""
    w = fit_curve(x, y)
    raw = np.c_[x, np.ones(len(x))] @ w
    order = np.argsort(-raw, kind="stable")
    hits = np.cumsum(y[order])
    taken = np.arange(1, len(y) + 1)
    lost, clean = taken - hits, len(y) - y.sum()
    f1 = np.where((lost == 0) | (lost + 1 <= clean_loss * clean), 2 * hits / (taken + y.sum()), 0)
    best = int(np.argmax(f1))
    cut = (raw[order[best]] + raw[order[min(best + 1, len(y) - 1)]]) / 2
    return np.r_[w[:-1], w[-1] - cut + np.log(threshold / (1 - threshold))]


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    settings: Settings


def fit(docs: DataFrame, labels: DataFrame, training: Column, threshold: float = 0.7, settings: Settings = SETTINGS) -> Model | None:
    """Fit on labelled rows for which ``training`` (a condition on ``doc_id``) holds; ``labels`` has ``doc_id`` and ``label``."""
    import zstandard as z

    runtime.bounded_batches(docs.sparkSession)
    known = labels.where(training & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "label")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))  # of labels that differ, the toxic one
    sample = common.written(
        common.hashed_sample(known.where("label = 1"), settings.toxic).unionByName(common.hashed_sample(known.where("label = 0"), settings.ordinary)),
        "toxicity-sample")
    # Bounded by the settings, so ids may be broadcast.
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().cast("binary").alias("text"))
    one = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", F.col("label").cast("int").alias("label")).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = common.written(with_origin(one), "toxicity-texts")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    places = common.written(texts.select("doc_id", "label").withColumn("place", F.row_number().over(order)), "toxicity-places")
    cuts = {r["label"]: max(1, int(settings.making * r["count"])) for r in places.groupBy("label").count().collect()}
    if len(cuts) < 2:
        return None
    making = F.col("place") <= F.when(F.col("label") == 1, cuts[1]).otherwise(cuts[0])
    texts = texts.join(F.broadcast(places.select("doc_id", "place")), "doc_id")
    toxic_words = toxic_part(texts.where(making), settings.toxic_bytes)
    if not toxic_words:  # nothing tells the classes apart
        return None
    pieces = training_windows(texts.where(making & (F.col("label") == 0) & (F.col("place") <= settings.trained_texts)), settings)
    try:
        common_part = z.train_dictionary(settings.dictionary_bytes, pieces, k=48, d=8).as_bytes()
    except z.ZstdError:  # too little text to train on: the windows themselves
        common_part = b"".join(pieces)[-settings.dictionary_bytes:] or b" "
    held = described(texts.where(~making), common_part, toxic_words, settings)
    if len(set(held[1])) < 2:
        held = described(texts, common_part, toxic_words, settings)
    return Model(common_part, toxic_words, calibrated(*held, threshold, settings.clean_loss), settings)


def training_windows(texts: DataFrame, settings: Settings) -> list[bytes]:
    """Windows of the texts ``(place, text)`` in order, as many as the settings allow."""

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for place, text in zip(frame.column(0).to_pylist(), frame.column(1), strict=True):
                found = windows(text.as_buffer().to_pybytes(), settings)[:settings.trained_windows]  # no text can give more
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], names=["place", "at", "piece"])

    cut = texts.select("place", "text").mapInArrow(work, "place int, at int, piece binary")
    return cut.orderBy("place", "at").limit(settings.trained_windows).select("piece").toArrow().column(0).to_pylist()


def described(texts: DataFrame, ordinary: bytes, toxic: bytes, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions and labels of the texts ``(doc_id, label, text)``, a row for each of the bounded sample."""

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(ordinary, toxic, settings)
        for frame in frames:
            x = [compressors.description(t.as_buffer().to_pybytes()) for t in frame.column(2)]
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows = texts.select("doc_id", "label", "text").mapInArrow(work, "doc_id bigint, label int, x array<double>")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return np.array([r["x"] for r in got]).reshape(-1, DESCRIBED), np.array([r["label"] for r in got], dtype=float)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    runtime.bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.whole_text().cast("binary").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    ordinary, toxic, weights, settings = model.ordinary, model.toxic, model.weights, model.settings

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(ordinary, toxic, settings)
        for batch in batches:
            x = np.array([compressors.description(t.as_buffer().to_pybytes()) for t in batch.column(1)]).reshape(-1, DESCRIBED)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(x @ weights[:-1] + weights[-1]), pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(work, "doc_id bigint, score double")


def without_toxic(docs: DataFrame, model: Model | None, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all columns. Each row is scored where it is read, so nothing is shuffled."""
    if model is None:
        return docs
    runtime.bounded_batches(docs.sparkSession)
    ordinary, toxic, weights, settings = model.ordinary, model.toxic, model.weights, model.settings

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(ordinary, toxic, settings)
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            x = np.array([compressors.description(t) for t in texts]).reshape(-1, DESCRIBED)
            yield batch.filter(pa.array(sigmoid(x @ weights[:-1] + weights[-1]) < threshold))

    return docs.mapInArrow(work, docs.schema)


runtime.ship_by_value(__name__)
