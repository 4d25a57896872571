"""Quality and leakage checks on a corpus.

Texts are grouped by their SHA-256 digest, so a shuffle moves 64 characters per
distinct text and not the text, and map-side aggregation folds many copies of one
text before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.sizing import per_class_table, skew_safe_lookup
from textloom.storage import materialise


def digest(column: str):
    return F.sha2(F.col(column), 256)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns]))
    )


def row_count_check(df: DataFrame, expected: int | None = None) -> DataFrame:
    """Row count against an expectation; without one the check passes."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"),
        F.lit(expected).cast("long").alias("expected"),
        (F.lit(True) if expected is None else n == expected).alias("passed"),
    )


def label_domain(df: DataFrame, expected: Sequence[str], columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Every label found or expected, and whether it is ``ok``, ``missing`` or ``unexpected``."""
    found = df.groupBy(F.col(columns.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    wanted = df.sparkSession.createDataFrame([(x,) for x in sorted(set(expected))], "label string")
    status = (
        F.when(F.col("wanted") & F.col("n").isNotNull(), "ok")
        .when(F.col("n").isNull(), "missing")
        .otherwise("unexpected")
    )
    return (
        found.join(wanted.withColumn("wanted", F.lit(True)), "label", "full_outer")
        .withColumn("wanted", F.coalesce("wanted", F.lit(False)))
        .select("label", F.coalesce("n", F.lit(0)).cast("long").alias("n"), status.alias("status"))
    )


def duplicate_summary(df: DataFrame, column: str, as_text: bool = True) -> DataFrame:
    """How many rows share their value of ``column`` with another row. One row."""
    key = digest(column) if as_text else F.col(column)
    groups = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return groups.agg(
        F.lit(column).alias("column_name"),
        F.count(F.lit(1)).alias("n_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_surplus"),
    )


def duplicate_members(df: DataFrame, column: str, as_text: bool = True) -> DataFrame:
    """All rows that share their value of ``column``, with the number of ``copies``.

    Missing values are equal, as in :func:`duplicate_summary`. A window over the value would
    pull one much-copied text into one task; the counts are joined back instead.
    """
    value = digest(column) if as_text else F.concat(F.lit("v"), F.col(column).cast("string"))
    keyed = df.withColumn("_value", F.coalesce(value, F.lit("none")))
    groups = keyed.groupBy("_value").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    return skew_safe_lookup(keyed, groups, "_value").drop("_value")


def label_conflicts(df: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Cleaned texts that carry more than one label: digest, labels, rows."""
    per_label = (
        df.groupBy(digest(columns.cleaned).alias("text_digest"), columns.label)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_label.groupBy("text_digest")
        .agg(F.count(columns.label).alias("n_labels"), F.sum("n").alias("n_rows"))
        .filter(F.col("n_labels") > 1)
    )


def class_distribution(df: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows and share per label."""
    counts = df.groupBy(F.col(columns.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, "n", "share")


def with_share(counts: DataFrame, n: str, share: str) -> DataFrame:
    """Adds ``n / total`` to a table with one row per class."""
    return counts.withColumn(share, F.col(n) / F.sum(n).over(per_class_table()))


def split_overlap(df: DataFrame, split: str = "split", columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Distinct cleaned texts per side and on both sides. One row."""
    sides = df.groupBy(digest(columns.cleaned).alias("key")).agg(
        F.bool_or(F.col(split) == "train").alias("in_train"),
        F.bool_or(F.col(split) == "test").alias("in_test"),
    )
    return sides.agg(
        F.count_if("in_train").alias("n_train_texts"),
        F.count_if("in_test").alias("n_test_texts"),
        F.count_if(F.col("in_train") & F.col("in_test")).alias("n_overlap"),
    )


def split_distribution(df: DataFrame, split: str = "split", columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Per label: rows in total, in train and in test, and the label's share of each side in percent."""
    counts = df.groupBy(F.col(columns.label).alias("label")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(split) == "train").alias("train"),
        F.count_if(F.col(split) == "test").alias("test"),
    )

    def pct(n: str):
        return F.round(F.try_divide(F.col(n) * 100, F.sum(n).over(per_class_table())), 4)

    return counts.select(
        "label", "total", "train", "test", pct("train").alias("train_pct"), pct("test").alias("test_pct")
    )


def fingerprints(prepared: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """A narrow stored table with digests in place of texts: the one pass over the texts
    that all checks of :func:`integrity_report` share."""
    nulls = sum((F.col(c).isNull().cast("int") for c in prepared.columns), F.lit(0))
    return materialise(
        prepared.select(
            columns.id,
            columns.label,
            digest(columns.text).alias(columns.text),
            digest(columns.cleaned).alias(columns.cleaned),
            nulls.alias("n_null"),
        ),
        "fingerprints",
    )


def integrity_report(
    prepared: DataFrame, expected_labels: Sequence[str], columns: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """The checks a corpus has to pass before it is split: ``check, value, passed``."""
    rows = fingerprints(prepared, columns)

    def one(df: DataFrame, check: str, value, blocking: bool = True) -> DataFrame:
        row = df.agg(F.coalesce(value, F.lit(0)).cast("long").alias("value"))
        passed = (F.col("value") == 0) if blocking else F.lit(True)
        return row.select(F.lit(check).alias("check"), "value", passed.alias("passed"))

    blocking = {columns.id: True, columns.text: False, columns.cleaned: False}
    parts = [
        one(rows, "null_values", F.sum("n_null")),
        one(label_domain(rows, expected_labels, columns), "labels_off_domain", F.count_if(F.col("status") != "ok")),
        *[
            one(duplicate_summary(rows, c, as_text=False), f"duplicate_{c}", F.sum("n_rows"), blocks)
            for c, blocks in blocking.items()
        ],
        one(label_conflicts(rows, columns), "conflicting_labels", F.count(F.lit(1))),
    ]
    return reduce(DataFrame.unionByName, parts)
