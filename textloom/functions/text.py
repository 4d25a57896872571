"""Text normalisation, tokens and n-grams as column expressions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------
ZERO_WIDTH = "\ufeff\u200b\u200e\u200f"
NO_BREAK_SPACE = "\u00a0"
QUOTES = {
    "“": '"',
    "”": '"',
    "‘": "'",
    "’": "'",
    "`": "'",
    "«": '"',
    "»": '"',
}
DASHES = {
    "–": "-",
    "—": "-",
    "―": "-",
    "−": "-",
}
# Runs of blanks that become one space; a lone space needs no work.
COLLAPSED_BLANKS = " [ \\t\\r\\n]+|[\\t\\r\\n][ \\t\\r\\n]*"
# What str.strip() takes off at both ends.
EDGE_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Word characters plus the whole Devanagari block, so vowel signs stay inside words.
TOKEN_PATTERN = "[\\u0900-\\u097F\\p{L}\\p{N}_]+"
# ------------------------------------------------------------------------

# A text without any of these holds no entity, is in NFC already and has no
# character to standardise. Left out are everything else below U+0300 and most of
# Devanagari; nukta letters and signs, Vedic accents and all other blocks are in.
_SPECIAL = (
    "[&`\\xa0\\xab\\xbb\\u0300-\\u08FF\\u093C\\u0951-\\u0954\\u0958-\\u095F"
    "\\u0980-\\x{10FFFF}]"
)


@F.pandas_udf(T.StringType())
def _unescape_and_compose(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", html.unescape(t)), na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unescape_html(text: Column) -> Column:
    """Decode HTML character references; rows without ``&`` send nothing to Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def standardise_characters(text: Column) -> Column:
    """Quotes, dashes and no-break spaces to ASCII; zero-width characters out."""
    single = {NO_BREAK_SPACE: " ", **QUOTES, **DASHES}
    return F.translate(text, "".join(single) + ZERO_WIDTH, "".join(single.values()))


def normalise_characters(text: Column) -> Column:
    """HTML unescape, NFC, then :func:`standardise_characters`.

    Spark has neither of the first two, so texts that may change visit Python in
    Arrow batches. All others stay in the JVM: Python sees a null for them, and
    the null picks the untouched text.
    """
    special = _unescape_and_compose(F.when(text.rlike(_SPECIAL), text))
    return F.coalesce(standardise_characters(special), text)


def strip(text: Column) -> Column:
    """``str.strip()``: every Unicode blank at both ends."""
    return F.btrim(text, F.lit(EDGE_BLANKS))


def collapse_blanks(text: Column) -> Column:
    return strip(F.regexp_replace(text, COLLAPSED_BLANKS, " "))


def clean_text(text: Column, lowercase: bool = True) -> Column:
    """The cleaning chain. The order matters: an entity may decode to a
    character that a later step removes. NULL becomes the empty string."""
    cleaned = normalise_characters(F.coalesce(text, F.lit("")))
    return collapse_blanks(F.lower(cleaned) if lowercase else cleaned)


def tokens(cleaned: Column) -> Column:
    return F.regexp_extract_all(cleaned, F.lit(TOKEN_PATTERN), F.lit(0))


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of ``low`` to ``high`` words, joined by one space."""
    if not 1 <= low <= high:
        raise ValueError("n-gram range must satisfy 1 <= low <= high")

    def runs(w: Column, n: int) -> Column:
        if n == 1:
            return w
        starts = F.sequence(F.lit(0), F.size(w) - n)
        joined = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) >= n, joined).otherwise(F.array().cast("array<string>"))

    return let(words, lambda w: F.concat(*[runs(w, n) for n in range(low, high + 1)]))


def term_counts(terms: Column) -> Column:
    """Array of ``(term, tf)``, one entry per distinct term.

    Sorting the row's own terms and measuring the runs keeps counting inside the
    row, where an explode and a group-by would shuffle every term of the corpus.
    """

    def measure(ordered: Column) -> Column:
        def is_start(i: Column) -> Column:
            return (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))

        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), is_start)
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda p, j: F.struct(
                    F.get(ordered, p).alias("term"),
                    (F.coalesce(F.get(s, j + 1), F.size(ordered)) - p).cast("long").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return let(F.sort_array(terms), lambda s: F.when(F.size(s) > 0, measure(s)).otherwise(empty))


def cleaned_term_counts(cleaned: Column, low: int = 1, high: int = 2) -> Column:
    return term_counts(ngrams(tokens(cleaned), low, high))
