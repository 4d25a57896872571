"""Evaluation from one table of counts per (actual, predicted) pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.operators.prepare import prepare
from textloom.sizing import per_class_table


def confusion_counts(predictions: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """``actual, predicted, n`` for the pairs that occur."""
    return predictions.groupBy(
        F.col(columns.label).alias("actual"), F.col("predicted_label").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """All pairs of ``labels`` in their order, zero where nothing occurred."""
    grid = [(i, a, j, p) for i, a in enumerate(labels) for j, p in enumerate(labels)]
    cells = counts.sparkSession.createDataFrame(grid, "row int, actual string, col int, predicted string")
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "row", "actual", "col", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def wide_confusion_matrix(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per actual label, one column per predicted label."""
    return (
        confusion_matrix(counts, labels)
        .groupBy("row", "actual")
        .pivot("predicted", list(labels))
        .agg(F.sum("n"))
        .orderBy("row")
        .drop("row")
    )


def normalised_confusion(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Each cell as a share of its actual label; NULL where the label does not occur."""
    row_total = F.sum("n").over(Window.partitionBy("actual"))
    return confusion_matrix(counts, labels).withColumn("share", F.try_divide(F.col("n"), row_total))


def class_report(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per label of the list; undefined ratios are 0."""
    actual = F.struct(
        F.col("actual").alias("label"),
        F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp"),
        F.col("n").alias("support"),
        F.lit(0).cast("long").alias("called"),
    )
    called = F.struct(
        F.col("predicted").alias("label"),
        F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("support"),
        F.col("n").alias("called"),
    )
    sums = (
        counts.select(F.inline(F.array(actual, called)))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "called")])
    )
    listed = counts.sparkSession.createDataFrame(list(enumerate(labels)), "position int, label string")
    zero = F.lit(0.0)
    return (
        listed.join(sums, "label", "left")
        .withColumn("precision", F.coalesce(F.try_divide("tp", "called"), zero))
        .withColumn("recall", F.coalesce(F.try_divide("tp", "support"), zero))
        .withColumn("f1", F.coalesce(F.try_divide(F.col("tp") * 2, F.col("support") + F.col("called")), zero))
        .select(
            "position",
            "label",
            "precision",
            "recall",
            "f1",
            F.coalesce("support", F.lit(0)).cast("long").alias("support"),
        )
    )


def overall_metrics(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Accuracy and macro and weighted precision, recall and F1. One row."""
    accuracy = counts.agg(
        (F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("Accuracy")
    ).withColumn("_one", F.lit(1))
    support = F.sum("support")

    def weighted(c: str):
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), support), F.lit(0.0))

    names = {"precision": "Precision", "recall": "Recall", "f1": "F1"}
    report = class_report(counts, labels).agg(
        *[F.avg(c).alias(f"Macro_{n}") for c, n in names.items()],
        *[weighted(c).alias(f"Weighted_{n}") for c, n in names.items()],
    )
    return accuracy.join(report.withColumn("_one", F.lit(1)), "_one").drop("_one")


def metric_gate(metrics: DataFrame, expected: dict[str, float], tolerance: float = 1e-4) -> DataFrame:
    """``metric, value, expected, passed`` for the metrics that have an expectation."""
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).alias("value"),
            F.lit(float(x)).alias("expected"),
            (F.abs(F.col(m) - F.lit(float(x))) < tolerance).alias("passed"),
        )
        for m, x in expected.items()
    ]
    return metrics.select(F.inline(F.array(*rows)))


def error_pairs(counts: DataFrame, top: int | None = None) -> DataFrame:
    """Wrong pairs by frequency, with their percentage of the actual class."""
    support = F.sum("n").over(Window.partitionBy("actual"))
    pairs = (
        counts.withColumn("_pct", F.round(F.col("n") / support * 100, 2))
        .filter(F.col("actual") != F.col("predicted"))
        .select(
            F.col("actual").alias("Actual_Label"),
            F.col("predicted").alias("Predicted_Label"),
            F.col("n").alias("Error_Count"),
            F.col("_pct").alias("Pct_of_Actual_Class"),
        )
    )
    ordered = pairs.orderBy(F.desc("Error_Count"), "Actual_Label", "Predicted_Label")
    return ordered if top is None else ordered.limit(top)


# Confidence bounds of the strata.
HIGH_CONFIDENCE = 0.70
MEDIUM_CONFIDENCE = 0.40


def errors_only(predictions: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return predictions.filter(F.col(columns.label) != F.col("predicted_label"))


def confidence_strata(predictions: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Errors with high, medium and low confidence; the share is NULL without errors."""
    confidence = F.round("predicted_probability", 4)
    strata = {
        "high": confidence >= HIGH_CONFIDENCE,
        "medium": (confidence >= MEDIUM_CONFIDENCE) & (confidence < HIGH_CONFIDENCE),
        "low": confidence < MEDIUM_CONFIDENCE,
    }
    counted = errors_only(predictions, columns).agg(*[F.count_if(c).alias(s) for s, c in strata.items()])
    rows = counted.select(F.inline(F.array(*[F.struct(F.lit(s).alias("stratum"), F.col(s).alias("n")) for s in strata])))
    return rows.withColumn("pct", F.round(F.try_divide(F.col("n") * 100, F.sum("n").over(per_class_table())), 2))


def error_analysis(
    predictions: DataFrame, documents: DataFrame, columns: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """Misclassified rows with their texts and the three best classes.

    Raw texts join the errors and only those are cleaned, unless ``documents``
    brings the cleaned text along. Classes a model does not have give NULLs.
    """
    ranks = [
        c
        for i in range(3)
        for c in (
            F.get("ranking", F.lit(i))["label"].alias(f"Top_{i + 1}_Class"),
            F.round(F.get("ranking", F.lit(i))["probability"], 4).alias(f"Top_{i + 1}_Probability"),
        )
    ]
    errors = errors_only(predictions, columns).select(
        columns.id,
        F.col(columns.label).alias("Actual_Label"),
        F.col("predicted_label").alias("Predicted_Label"),
        F.round("predicted_probability", 4).alias("Prediction_Confidence"),
        *ranks,
    )
    texts = [columns.text, *([columns.cleaned] if columns.cleaned in documents.columns else [])]
    joined = errors.join(documents.select(columns.id, *texts), columns.id)
    complete = joined if columns.cleaned in texts else prepare(joined, columns)
    rest = [c for c in errors.columns if c != columns.id]
    return complete.select(columns.id, columns.text, columns.cleaned, *rest)
