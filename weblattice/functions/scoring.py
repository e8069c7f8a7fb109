"""Score columns: the word score and the BM25 term weight."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weights of the word score and BM25 parameters.
FREQUENCY_WEIGHT = 10
EXACT_BONUS = 1000
DEPTH_PENALTY = 5
BM25_K1 = 1.2
BM25_B = 0.75
MIN_IDF = 1e-6


def word_score(frequency: Column, depth: Column, exact: Column | None = None) -> Column:
    bonus = F.lit(EXACT_BONUS) if exact is None else F.when(exact, EXACT_BONUS).otherwise(0)
    return frequency * FREQUENCY_WEIGHT + bonus - depth * DEPTH_PENALTY


def inverse_frequency(n_docs: Column, n_matching: Column) -> Column:
    """``ln((N - n + 0.5) / (n + 0.5))``, with a small floor for phrases in most documents."""
    idf = F.log((n_docs - n_matching + 0.5) / (n_matching + 0.5))
    return F.when(idf <= 0, MIN_IDF).otherwise(idf)


def bm25_weight(frequency: Column, idf: Column, n_tokens: Column, avg_tokens: Column) -> Column:
    length_norm = (1 - BM25_B) + BM25_B * n_tokens / avg_tokens
    return idf * frequency * (BM25_K1 + 1) / (frequency + BM25_K1 * length_norm)
