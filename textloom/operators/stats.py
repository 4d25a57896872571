"""Corpus and category statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns, text_column
from textloom.functions.profile import word_count
from textloom.operators.split import order_key
from textloom.sizing import per_class_table


def corpus_statistics(df: DataFrame, split: str = "split", columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """One row per label: its rows and percentage, beside the corpus totals."""
    counts = df.groupBy(F.col(columns.label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(split) == "train").alias("_train"),
        F.count_if(F.col(split) == "test").alias("_test"),
    )
    total = F.sum("n").over(per_class_table())
    return counts.select(
        "label",
        "n",
        F.round(F.col("n") / total * 100, 2).alias("pct"),
        total.alias("total_records"),
        F.count("label").over(per_class_table()).alias("total_categories"),
        F.sum("_train").over(per_class_table()).alias("train_records"),
        F.sum("_test").over(per_class_table()).alias("test_records"),
    )


def corpus_statistics_record(df: DataFrame, split: str = "split", columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The same as one row with maps from label to count and percentage."""
    totals = ["total_records", "total_categories", "train_records", "test_records"]
    return (
        corpus_statistics(df, split, columns)
        .groupBy(*totals)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("category_counts"),
            F.map_from_entries(F.collect_list(F.struct("label", "pct"))).alias("category_percentages"),
        )
    )


def category_profile(df: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Per label: rows, percentage of the corpus, mean words per raw text."""
    text = columns.text if columns.text in df.columns else text_column(df.columns)
    counts = df.groupBy(F.col(columns.label).alias("label")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(word_count(F.coalesce(F.col(text), F.lit("")))).alias("_words"),
    )
    return counts.select(
        "label",
        "record_count",
        F.round(F.col("record_count") / F.sum("record_count").over(per_class_table()) * 100, 2).alias("percentage"),
        F.round(F.col("_words") / F.col("record_count"), 1).alias("avg_words"),
    )


def in_category(df: DataFrame, category: str, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows of one label, whatever the case; ``all`` or blank keeps every row."""
    wanted = category.strip().lower()
    if wanted in ("", "all"):
        return df
    return df.filter(F.lower(columns.label) == wanted)


def category_check(df: DataFrame, category: str, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows behind a category name and whether the name is known. One row."""
    return in_category(df, category, columns).agg(
        F.lit(category.strip()).alias("category"),
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) > 0).alias("known"),
    )


def category_samples(df: DataFrame, n: int = 5, seed: int = 42, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Up to ``n`` rows per label in seeded order.

    The rank filter lets Spark cut each map task down to ``n`` rows per label
    before the shuffle, so a label that owns most rows costs no more than others.
    """
    order = Window.partitionBy(columns.label).orderBy("_order", columns.id)
    return (
        df.withColumn("_order", order_key(columns.id, seed))
        .withColumn("sample_rank", F.row_number().over(order))
        .filter(F.col("sample_rank") <= n)
        .drop("_order")
    )


def random_rows(
    df: DataFrame, n: int = 1, seed: int = 42, category: str = "all", columns: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """``n`` rows in seeded order, of the whole table or of one category."""
    return (
        in_category(df, category, columns)
        .withColumn("_order", order_key(columns.id, seed))
        .orderBy("_order", columns.id)
        .limit(n)
        .drop("_order")
    )
