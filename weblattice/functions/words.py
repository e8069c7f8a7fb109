"""Word columns: ASCII word tokens, stop words, per-text word counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The stop words of the word index.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in",
    "is", "it", "of", "on", "or", "that", "the", "to", "was", "were", "with",
)


def word_tokens(text: Column) -> Column:
    """All runs of ``[a-z0-9]`` of the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


# One token that is_index_word accepts; leaving the others out here spares sorting them later.
_INDEX_WORD = rf"(?<![a-z0-9])(?!(?:{'|'.join(STOP_WORDS)})(?![a-z0-9]))[a-z0-9]{{2,}}"


def index_words(text: Column) -> Column:
    """The word tokens of the text that are longer than one letter and not stop words."""
    return F.regexp_extract_all(F.lower(text), F.lit(_INDEX_WORD), F.lit(0))


def is_index_word(word: Column) -> Column:
    return (F.length(word) > 1) & ~word.isin(*STOP_WORDS)


def normalize_query(query: Column) -> Column:
    return F.lower(F.regexp_replace(query, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", ""))


def repeat_runs(tokens: Column) -> Column:
    """Group equal tokens of one array without a shuffle.

    The tokens are sorted and joined, so equal ones stand side by side, and one back-reference
    pattern cuts the string into runs: ``a b a`` -> ``a a ``, ``b ``. Tokens hold no blanks.
    """
    lined = F.concat(F.array_join(F.sort_array(tokens), " "), F.lit(" "))
    return F.regexp_extract_all(lined, F.lit(r"(\S+ )\1*"), F.lit(0))


def run_token(run: Column) -> Column:
    return F.substring_index(run, " ", 1)


def run_length(run: Column, token: Column) -> Column:
    return F.call_function("div", F.length(run), F.length(token) + 1).cast("int")
