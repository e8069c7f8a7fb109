"""Full-text columns: Unicode word tokens, case and diacritic folding."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}\p{Co}]+"

# Combining marks that belong to the token they stand in and are dropped from it.
DROPPED_MARKS = (
    0x300, 0x301, 0x302, 0x303, 0x304, 0x306, 0x307, 0x308, 0x309, 0x30A, 0x30B, 0x30C, 0x30F,
    0x311, 0x31B, 0x323, 0x324, 0x325, 0x326, 0x327, 0x328, 0x32D, 0x32E, 0x330, 0x331,
)


def _folded(letter: str) -> str:
    """Simple case folding, then an ASCII letter for one that carries exactly one mark."""
    lowered = letter.casefold()
    if len(lowered) != 1:
        lowered = letter.lower() if len(letter.lower()) == 1 else letter
    parts = unicodedata.normalize("NFD", lowered)
    if len(parts) == 2 and parts[0].isascii() and parts[0].isalpha():
        return parts[0]
    return lowered


@cache
def fold_table() -> tuple[str, str]:
    """``translate`` arguments, derived from the Unicode database by the rule above."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        letter = chr(code)
        if unicodedata.category(letter)[0] in "LN" and letter.lower() == letter:
            folded = _folded(letter)
            if folded != letter and len(folded) == 1:
                source.append(letter)
                target.append(folded)
    source += [chr(mark) for mark in DROPPED_MARKS]  # no counterpart: translate deletes them
    return "".join(source), "".join(target)


def fold(text: Column) -> Column:
    """Lower case without diacritics. ``straße`` keeps its ``ß``; two marks on a letter stay."""
    lowered = F.lower(text)
    source, target = fold_table()
    is_ascii = F.octet_length(lowered) == F.length(lowered)
    return F.when(is_ascii, lowered).otherwise(F.translate(lowered, source, target))


def text_tokens(text: Column) -> Column:
    """Folded Unicode word tokens in order; single letters and stop words are kept."""
    return F.regexp_extract_all(fold(text), F.lit(TOKEN_PATTERN), F.lit(0))
