"""Porter's stemmer as Spark column steps (M. F. Porter, An algorithm for suffix stripping, 1980).

The measure conditions of the paper are regular expressions over the stem, so each step is one suffix
match and one lookup, all JVM-side. It is meant for a vocabulary, one row per distinct term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MIN_BYTES, MAX_BYTES = 3, 64  # other terms are kept unchanged

# Consonant run and vowel run; y is a vowel after a consonant, and a consonant at the start.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
_HAS_VOWEL = f"^(?:{_C}[aeiouy]|[aeiou])"
_MEASURE_OVER_0 = f"{_HAS_VOWEL}[aeiou]*{_C}"
_MEASURE_IS_1 = f"{_MEASURE_OVER_0}(?:{_V})?$"
_MEASURE_OVER_1 = f"{_MEASURE_OVER_0}{_V}{_C}"
# consonant, vowel, consonant at the end, the last not w, x or y (and a plain letter or digit)
_ENDS_CVC = "(?:[^aeiouy]|(?:^|[aeiou])y)[aeiouy][b-df-hj-np-tvz0-9]$"
_DOUBLE = r"([b-df-hj-np-tv-z0-9])\1$"

# Suffix tables of the paper.
_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
_STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _cut(word: Column, suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """Stem and suffix for the longest of the suffixes that ends the word; empty if none does."""
    pattern = f"^(.+?)({'|'.join(suffixes)})$"
    return F.regexp_extract(word, pattern, 1), F.regexp_extract(word, pattern, 2)


def _replace(word: Column, table: dict[str, str]) -> Column:
    stem, suffix = _cut(word, tuple(table))
    mapping = F.create_map(*[F.lit(text) for pair in table.items() for text in pair])
    return F.when((suffix != "") & stem.rlike(_MEASURE_OVER_0), F.concat(stem, mapping[suffix])).otherwise(word)


def _plural(word: Column) -> Column:
    return (
        F.when(word.rlike("^.+(?:sses|ies)$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike("[^s]s$"), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def _past(word: Column) -> Column:
    """Cut ``-ed`` and ``-ing``; a word that was cut is marked with a trailing ``|``."""
    stem, suffix = _cut(word, ("eed", "ed", "ing"))
    return (
        F.when(suffix == "eed", F.when(stem.rlike(_MEASURE_OVER_0), F.concat(stem, F.lit("ee"))).otherwise(word))
        .when((suffix != "") & stem.rlike(_HAS_VOWEL), F.concat(stem, F.lit("|")))
        .otherwise(word)
    )


def _tidy(marked: Column) -> Column:
    """Restore an ``e`` or undouble after a cut, and drop the mark."""
    stem = F.regexp_replace(marked, r"\|$", "")
    return (
        F.when(~marked.endswith("|"), marked)
        .when(stem.rlike("^.+(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(stem.rlike(_DOUBLE) & ~stem.rlike("[lsz]$"), F.regexp_replace(stem, ".$", ""))
        .when(stem.rlike(_MEASURE_IS_1) & stem.rlike(_ENDS_CVC), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def _final_y(word: Column) -> Column:
    stem, suffix = _cut(word, ("y",))
    return F.when((suffix != "") & stem.rlike(_HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(word)


def _double_suffix(word: Column) -> Column:
    return _replace(word, _STEP_2)


def _full_suffix(word: Column) -> Column:
    return _replace(word, _STEP_3)


def _drop_suffix(word: Column) -> Column:
    stem, suffix = _cut(word, _STEP_4)
    fits = stem.rlike(_MEASURE_OVER_1) & ((suffix != "ion") | stem.rlike("[st]$"))
    return F.when((suffix != "") & fits, stem).otherwise(word)


def _final_e(word: Column) -> Column:
    stem, suffix = _cut(word, ("e",))
    fits = stem.rlike(_MEASURE_OVER_1) | (stem.rlike(_MEASURE_IS_1) & ~stem.rlike(_ENDS_CVC))
    return F.when((suffix != "") & fits, stem).otherwise(word)


def _final_ll(word: Column) -> Column:
    stem = F.regexp_replace(word, "l$", "")
    return F.when(word.endswith("ll") & stem.rlike(_MEASURE_OVER_1), stem).otherwise(word)


_STEPS = (
    _plural, _past, _tidy, _final_y, _double_suffix, _full_suffix,
    _drop_suffix, _final_e, _final_ll,
)


def porter_stem(term: Column) -> Column:
    """The stem of a folded term.

    Each step is a lambda over a one-element array. So its input is evaluated once, and the expression
    grows by one step at a time when the optimizer moves a filter on the stem.
    """
    stem = term
    for step in _STEPS:
        stem = F.transform(F.array(stem), step)[0]
    return F.when(F.octet_length(term).between(MIN_BYTES, MAX_BYTES), stem).otherwise(term)


def with_stem(terms: DataFrame, term: str = "term", stem: str = "stem") -> DataFrame:
    return terms.withColumn(stem, porter_stem(F.col(term)))
