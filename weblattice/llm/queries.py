"""The queries of the operators, one for each, on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblattice.llm import (
    best_fit,
    bit_sliced,
    common,
    conversation_trie,
    covering_simhash,
    exact_index,
    line_frequency,
    pu_quality,
    secret_entropy,
    segment_bpe,
    suffix_index,
    token_alignment,
    winnowed_lines,
    zstd_toxicity,
)


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held_out = common.fold("doc_id", 5) == 0
    model = pu_quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")), ~held_out)
    return predicted(pu_quality.scored(docs, model), held_out, 0.3)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held_out = common.fold("doc_id", 3) == 1
    model = zstd_toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")), ~held_out, 0.7)
    return predicted(zstd_toxicity.scored(docs, model), held_out, 0.7)


def predicted(scores: DataFrame, held_out, threshold: float) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.digest(suffix_index.remains(common.table(spark, sf_dir, "documents")))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_simhash.grouped(common.table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as one batch for a new index; the answer is read from the index, which is dropped then."""
    name = f"exact_{common.runtime.new_folder(spark, 'x')[-32:]}"
    exact_index.create_index(spark, name, common.partitions(spark))
    found = common.written(exact_index.digests(common.table(spark, sf_dir, "documents")), "exact-digests")
    exact_index.append(name, found)
    answer = common.written(exact_index.membership(found, exact_index.entries_of(spark, name)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")), "exact-answer")
    exact_index.drop_index(spark, name)
    return answer


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_bpe.encoded(common.table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.judged(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_entropy.scanned(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[secret_entropy.number_of(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_entropy.written_out("__base").cast("binary"), 256).alias("base_sha256"), secret_entropy.written_out("__all").alias("spans"))


def line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowed_lines.deduplicated(common.table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(common.whole_text().cast("binary"), 256).alias("kept_sha256"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.packed(common.table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(common.table(spark, sf_dir, "conversations"))


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 50 against all rows."""
    return bit_sliced.search(bit_sliced.build(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0), 5)


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(common.table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality,
    "op2_toxicity": toxicity,
    "op3_suffix_dedup": suffixes,
    "op4_simhash": simhash,
    "op5_exact_dedup": exact,
    "op6_bpe": bpe,
    "op7_quality_rules": rules,
    "op8_secrets": secrets,
    "op9_line_dedup": line_runs,
    "op10_packing": packing,
    "op11_prefix_trie": prefix_trie,
    "op12_top_k": top_k,
    "op13_alignment": alignment,
}
