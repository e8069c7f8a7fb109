"""Workers take texts in batches bounded in bytes, in a session of default settings too."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import best_fit, shingle_jaccard, zstd_toxicity
from weblattice.operators.extraction import extract_pages


@pytest.fixture
def defaults(spark):
    given = {runtime.BATCH_ROWS: "10000", runtime.BATCH_BYTES: "64m"}
    before = {key: spark.conf.get(key) for key in given}
    for key, value in given.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def largest(rows):
    """Bytes of the largest batch that a worker gets."""
    sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n bigint")
    return max(r["n"] for r in sizes.collect())


def test_a_smaller_setting_stays(defaults):
    for given, kept in (("64m", "4194304"), ("67108864b", "4194304"), ("1g", "4194304"), ("4m", "4m"), ("512k", "512k"), ("1000", "1000")):
        defaults.conf.set(runtime.BATCH_BYTES, given)
        runtime.bounded_batches(defaults)
        assert defaults.conf.get(runtime.BATCH_BYTES).rstrip("b") == kept


@pytest.mark.parametrize("operator", [
    lambda docs: shingle_jaccard.grouped(docs),
    lambda docs: best_fit.pieces(docs, "unused"),
    lambda docs: zstd_toxicity.without_toxic(docs, zstd_toxicity.Model(b"a", b"b", None, zstd_toxicity.SETTINGS), 0.7),
    lambda docs: zstd_toxicity.scored(docs, zstd_toxicity.Model(b"a", b"b", None, zstd_toxicity.SETTINGS)),
])
def test_texts_come_in_bounded_batches(defaults, frame, operator):
    long = defaults.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"))  # 30 MB
    operator(frame([(1, "a b c d e f"), (2, None)]))
    assert largest(long) < 5 << 20


def test_long_pages_come_in_bounded_batches(defaults):
    """500 pages of 50 kB would be 25 MB."""
    raw = defaults.range(0, 600, 1, 1).select(
        F.concat(F.lit("http://h/"), "id").alias("url"), F.lit(200).alias("status_code"), F.lit("text/html").alias("content_type"),
        F.repeat(F.lit("<p>x"), 12_500).alias("body"), F.lit(None).cast("string").alias("error"))
    extract_pages(raw)
    assert largest(raw) < 5 << 20
