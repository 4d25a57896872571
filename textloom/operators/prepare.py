"""Apply the text functions to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns, text_column
from textloom.functions import profile
from textloom.functions.text import clean_text


def prepare(df: DataFrame, columns: Columns = DEFAULT_COLUMNS, lowercase: bool = True) -> DataFrame:
    """The table plus its cleaned text: every row and every column is kept."""
    source = columns.text if columns.text in df.columns else text_column(df.columns)
    return df.withColumn(columns.cleaned, clean_text(F.col(source), lowercase))


def change_rate(prepared: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """How many texts the cleaning changed or emptied. One row."""
    changed = F.coalesce(F.col(columns.text), F.lit("")) != F.col(columns.cleaned)
    return prepared.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(changed).alias("n_changed"),
        F.count_if(F.length(columns.cleaned) == 0).alias("n_empty"),
        F.round(F.avg(changed.cast("int")) * 100, 4).alias("changed_pct"),
    )


def empty_after_cleaning(prepared: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return prepared.filter(F.length(columns.cleaned) == 0)


def with_profile(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``words, chars, devanagari_pct, latin_pct, digits``; the letter counts are made once."""
    devanagari, latin = F.col("devanagari"), F.col("latin")
    return (
        df.withColumns(profile.text_counts(text))
        .withColumns(
            {
                "devanagari_pct": profile.letter_share(devanagari, latin),
                "latin_pct": profile.letter_share(latin, devanagari),
            }
        )
        .drop("devanagari", "latin")
    )


def script_flags(prepared: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows per script: Devanagari, Latin, both, and with digits. One row."""
    text = F.col(columns.cleaned)
    return prepared.agg(
        F.count_if(profile.has_devanagari(text)).alias("n_devanagari"),
        F.count_if(profile.has_latin(text)).alias("n_latin"),
        F.count_if(profile.is_code_mixed(text)).alias("n_code_mixed"),
        F.count_if(profile.has_digit(text)).alias("n_with_digits"),
    )


def validated(prepared: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Adds ``error``: NULL for a text that can be scored."""
    return prepared.withColumn("error", profile.input_error(F.col(columns.text), F.col(columns.cleaned)))
