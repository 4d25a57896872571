"""Compare the candidates, select one, refit it on everything."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, METRIC_COLUMNS, Columns
from textloom.operators import linear, metrics, naive_bayes
from textloom.operators.classifier import TextClassifier
from textloom.operators.fused import FusedClassifiers
from textloom.operators.term_statistics import TermStatistics, counted
from textloom.operators.tfidf import TfidfConfig, TfidfModel, fit_tfidf
from textloom.sources.artifacts import Measured, save_classifier
from textloom.storage import materialise

Fit = Callable[[], TextClassifier]


def candidates(
    train: DataFrame, config: TfidfConfig = TfidfConfig(), columns: Columns = DEFAULT_COLUMNS
) -> dict[str, Fit]:
    """The five candidates by name. Vocabulary and vectors are made once and shared."""
    tfidf = fit_tfidf(train, config, columns)
    data = linear.TrainingSet(train, config, columns, tfidf)
    return {
        naive_bayes.NAME: lambda: naive_bayes.fit_naive_bayes(train, config, columns, tfidf=tfidf),
        linear.LOGISTIC: lambda: linear.fit_logistic(data),
        linear.LOGISTIC_BALANCED: lambda: linear.fit_logistic(data, balanced=True),
        linear.SVM: lambda: linear.fit_svm(data),
        linear.SVM_BALANCED: lambda: linear.fit_svm(data, balanced=True),
    }


def evaluate_candidate(fit: Fit, test: DataFrame) -> tuple[TextClassifier, DataFrame, DataFrame]:
    """Fit, predict the test side, measure: the classifier, its predictions, one metric row.

    Both times cover finished work: the fit ends with stored tables, and the
    predictions are stored before the clock stops.
    """
    started = time.perf_counter()
    classifier = fit()
    trained = time.perf_counter()
    predictions = materialise(classifier.predict(test, keep=[classifier.columns.label]), "predictions")
    predicted = time.perf_counter()
    counts = metrics.confusion_counts(predictions, classifier.columns)
    return classifier, predictions, _metric_row(classifier, counts, trained - started, predicted - trained)


def _metric_row(classifier: TextClassifier, counts: DataFrame, training: float, prediction: float) -> DataFrame:
    row = metrics.overall_metrics(counts, classifier.labels).select(
        F.lit(classifier.name).alias("Model"),
        "*",
        F.lit(training).alias("Training_Time"),
        F.lit(prediction).alias("Prediction_Time"),
        F.lit(classifier.has_probability).alias("Supports_Proba"),
    )
    return row.select(*METRIC_COLUMNS)


def compare(fits: dict[str, Fit], test: DataFrame) -> tuple[dict[str, TextClassifier], DataFrame]:
    """All candidates on the same test rows: the classifiers and one metric row each.

    The candidates share a vocabulary, so one pass over the test side scores all of them;
    ``Prediction_Time`` is that of the pass, the same for all.
    """
    fitted, seconds = {}, {}
    for name, fit in fits.items():
        started = time.perf_counter()
        fitted[name] = fit()
        seconds[name] = time.perf_counter() - started
    started = time.perf_counter()
    counts = FusedClassifiers(list(fitted.values())).confusion_counts(test)
    predicted = time.perf_counter() - started
    rows = None
    for i, (name, classifier) in enumerate(fitted.items()):
        row = _metric_row(classifier, counts.filter(F.col("model") == i).drop("model"), seconds[name], predicted)
        rows = row if rows is None else rows.unionByName(row)
    return fitted, materialise(rows, "model-results")


def select_model(results: DataFrame) -> DataFrame:
    """The best candidate by macro F1 among those with probabilities."""
    return results.filter("Supports_Proba").orderBy(F.desc("Macro_F1"), F.asc("Model")).limit(1)


def refit_on_everything(
    corpus: DataFrame,
    config: TfidfConfig = TfidfConfig(),
    columns: Columns = DEFAULT_COLUMNS,
    tfidf: TfidfModel | None = None,
) -> TextClassifier:
    """The production model: balanced logistic regression on all rows.

    Its training rows include the test side, so it must not be evaluated there.
    """
    return linear.fit_logistic(linear.TrainingSet(corpus, config, columns, tfidf), balanced=True)


def train_production(
    corpus: DataFrame,
    path: str,
    config: TfidfConfig = TfidfConfig(),
    columns: Columns = DEFAULT_COLUMNS,
    split: str = "split",
) -> TextClassifier:
    """Measure on the held-out side, refit on all rows, store the model with what was measured.

    Texts are cut into terms once. The statistics of all rows are those of the two sides
    merged, and both fits and the held-out predictions read the stored counts.
    """
    rows = counted(corpus, config, columns, keep=[columns.label, split])
    train, test = (rows.filter(F.col(split) == side) for side in ("train", "test"))
    of_train = TermStatistics.of(train, config, columns)
    rest = rows.filter(~F.col(split).eqNullSafe("train"))
    of_all = of_train.merge(TermStatistics.of(rest, config, columns))
    held_out = linear.fit_logistic(linear.TrainingSet(train, config, columns, of_train.fit(config, columns)), balanced=True)
    counts = materialise(
        metrics.confusion_counts(held_out.predict(test, keep=[columns.label]), columns), "confusion"
    )
    report = metrics.class_report(counts, held_out.labels).collect()
    measured = Measured(
        metrics.overall_metrics(counts, held_out.labels).first().asDict(),
        {r["label"]: r["f1"] for r in report},
        {r["label"]: r["recall"] for r in report},
        counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0],
    )
    production = refit_on_everything(rows, config, columns, of_all.fit(config, columns))
    save_classifier(production, path, measured)
    return production
