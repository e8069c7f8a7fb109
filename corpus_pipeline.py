"""A corpus pipeline over ``documents``: toxicity, exact dedup, near-dedup, secrets, packing.

Each stage takes what its predecessor kept, as a written table, and returns the columns of ``documents``; the last returns packed pieces.
SQL can express neither compression distances nor SimHash nor similar shingle sets nor tokens, so there is no oracle: the tests hold the stages against
plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblattice.llm import best_fit, common, exact_index, secret_entropy, shingle_jaccard, zstd_toxicity
from weblattice.llm.queries import tokenizer

ORACLE_SQL: str | None = None

#: A document goes at this score or above.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold. The model is fitted on the labelled rows of ``docs``; null texts stay."""
    labels = common.table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = zstd_toxicity.fit(docs, labels, common.fold("doc_id", 3) != 1, TOXIC)
    return zstd_toxicity.without_toxic(docs, model, TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each text that is equal but for white space."""
    return exact_index.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five-word shingles with a Jaccard similarity of 0.8 or more.

    Candidates are what covering SimHash links, and what shares a fingerprint of minima beyond its radius; all are compared exactly.
    """
    return shingle_jaccard.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret; ``n_chars`` follows the text."""
    clean = secret_entropy.redacted(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, packed to sequences."""
    return best_fit.packed(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
