"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A run of Latin letters that stands alone, and the Latin-1 letters without their marks.
LETTER_WORD = r"(?<![\p{L}\p{N}_])[A-Za-zÀ-ÿ]++(?![\p{L}\p{N}_])"
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝŸàáâãäåçèéêëìíîïðñòóôõö÷øùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIIDNOOOOOxOUUUUYYaaaaaaceeeeiiiidnooooo/ouuuuyy"
TWO_LETTER = {"Æ": "AE", "æ": "ae", "Þ": "Th", "þ": "th", "ß": "ss"}


def contains_letters(col: Column, pattern: str = "[A-Za-z]") -> Column:
    """True where the text matches; null text does not."""
    return F.coalesce(col.rlike(pattern), F.lit(False))


def decimal_comma(col: Column) -> Column:
    """Number written with a decimal comma; null where the result is no number."""
    return F.replace(col, F.lit(","), F.lit(".")).try_cast("double")


def letter_words(col: Column) -> Column:
    """The words made of Latin letters only, joined by one blank, in title case. Null gives ''."""
    words = F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(LETTER_WORD), F.lit(0))
    titled = F.initcap(F.array_join(words, " "))
    return F.regexp_replace(titled, r"(?<!\p{L})ß", "Ss")


def strip_accents(col: Column) -> Column:
    """Latin-1 letters to ASCII."""
    out = F.translate(col, MARKED, PLAIN)
    for letter, pair in TWO_LETTER.items():
        out = F.replace(out, F.lit(letter), F.lit(pair))
    return out
