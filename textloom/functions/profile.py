"""Per-row text measures and row checks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import clean_text, strip

# Fixed values -----------------------------------------------------------
DEVANAGARI = "\\u0900-\\u097F"
LATIN = "A-Za-z"
DIGITS = "0-9\\u0966-\\u096F"
ASTRAL = "\\x{10000}-\\x{10FFFF}"
# Blanks of str.split(), and of a browser. \p{Z} holds all Unicode space separators.
BLANKS = "\\t-\\r\\x1c-\\x1f\\x85\\p{Z}"
BROWSER_BLANKS = "\\t-\\r\\ufeff\\p{Z}"
# ------------------------------------------------------------------------

INPUT_IS_NULL = "input is null"
INPUT_IS_BLANK = "input is blank"
NOTHING_READABLE = "input has no readable text"


def count_of(text: Column, character_class: str) -> Column:
    """How many characters of ``text`` belong to the class."""
    return F.length(F.regexp_replace(text, f"[^{character_class}]+", "")).cast("long")


def _count_words(text: Column, blanks: str) -> Column:
    """Runs of non-blanks: each run and the blanks after it become one mark, the marks are counted."""
    led = F.regexp_replace(text, f"^[{blanks}]+", "")
    return F.length(F.regexp_replace(led, f"[^{blanks}]+[{blanks}]*", "w")).cast("long")


def word_count(text: Column) -> Column:
    """Number of blank-separated words, blanks as in ``str.split()``."""
    return _count_words(text, BLANKS)


def _half_up(x: Column) -> Column:
    return F.floor(x + 0.5).cast("long")


def text_counts(text: Column) -> dict[str, Column]:
    """Words, UTF-16 length, Devanagari and Latin letters, digits."""
    return {
        "words": _count_words(text, BROWSER_BLANKS),
        "chars": F.length(text).cast("long") + count_of(text, ASTRAL),
        "devanagari": count_of(text, DEVANAGARI),
        "latin": count_of(text, LATIN),
        "digits": count_of(text, DIGITS),
    }


def letter_share(part: Column, other: Column) -> Column:
    """``part`` in percent of both letter counts, rounded half up; 0 without letters."""
    return F.coalesce(_half_up(F.try_divide(part, part + other) * 100), F.lit(0).cast("long"))


def has_devanagari(text: Column) -> Column:
    return text.rlike(f"[{DEVANAGARI}]")


def has_latin(text: Column) -> Column:
    return text.rlike(f"[{LATIN}]")


def is_code_mixed(text: Column) -> Column:
    return has_devanagari(text) & has_latin(text)


def has_digit(text: Column) -> Column:
    return text.rlike(f"[{DIGITS}]")


def input_error(text: Column, cleaned: Column | None = None) -> Column:
    """Why a text cannot be scored, or NULL. Pass ``cleaned`` where it exists already."""
    cleaned = clean_text(text) if cleaned is None else cleaned
    return (
        F.when(text.isNull(), F.lit(INPUT_IS_NULL))
        .when(strip(text) == "", F.lit(INPUT_IS_BLANK))
        .when(cleaned == "", F.lit(NOTHING_READABLE))
    )


def percentage(share: Column) -> Column:
    """``0.52901`` as ``52.90%``."""
    return F.format_string("%.2f%%", share * 100)
