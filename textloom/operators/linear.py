"""Logistic regression and linear SVM candidates on Spark ML.

The penalty follows the convention ``0.5 * |w|^2 + C * sum(weight * loss)``; Spark
ML divides the loss by the total weight, so ``regParam = 1 / (C * total weight)``
with features left unscaled gives the same optimum. Spark's ``LinearSVC``
minimises the plain hinge loss and does not penalise the intercept; ``fit_squared_hinge``
minimises the squared hinge with the intercept penalised like a weight.

Beyond ``MAX_COEFFICIENTS`` a model does not fit on the driver, and training takes the tables
of ``term_partitioned`` instead.
"""

from __future__ import annotations

from functools import cached_property
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.operators.classifier import TextClassifier, class_counts
from textloom.operators.one_stage import tasks_for
from textloom.operators.tfidf import TfidfConfig, TfidfModel, fit_tfidf
from textloom.operators.term_partitioned import LOGISTIC_LOSS, SQUARED_HINGE, Loss, TermPartitionedSet, fit_term_partitioned
from textloom.storage import materialise

# Spark ML keeps some thirty vectors of classes x terms doubles on the driver, ten pairs of L-BFGS among them, and sends one
# out in every step: 120 MB in all for so many.
MAX_COEFFICIENTS = 500_000

LOGISTIC = "Logistic Regression"
LOGISTIC_BALANCED = "Logistic Regression (Balanced)"
SVM = "Linear SVM"
SVM_BALANCED = "Linear SVM (Balanced)"


class TrainingSet:
    """TF-IDF vectors of the training rows, stored once and shared by all candidates."""

    def __init__(
        self,
        train: DataFrame,
        config: TfidfConfig = TfidfConfig(),
        columns: Columns = DEFAULT_COLUMNS,
        tfidf: TfidfModel | None = None,
    ):
        self.columns = columns
        self.tfidf = tfidf or fit_tfidf(train, config, columns)
        self.counts = class_counts(train, columns)
        self.labels = [label for label, _ in self.counts]
        self.n_rows = sum(n for _, n in self.counts)
        self.train = train
        self.on_driver = len(self.labels) * self.tfidf.n_terms <= MAX_COEFFICIENTS
        if self.on_driver:
            self.vectors = self.stored_vectors()

    @cached_property
    def vocabulary(self) -> DataFrame:
        return materialise(self.tfidf.indexed_vocabulary().select("term", "df", "idf", "idx"), "vocabulary")

    def stored_vectors(self) -> DataFrame:
        """The features as Spark ML vectors; what is trained in tables does without."""
        return self.tfidf.vectors(self.train, self.vocabulary, keep=[self.columns.label])

    @cached_property
    def in_tables(self) -> TermPartitionedSet:
        """The features cut for training in tables, once for all fits."""
        return TermPartitionedSet(self.train, self.tfidf.config, self.columns, self.tfidf)

    @cached_property
    def packed(self) -> DataFrame:
        """The stored vectors in no more tasks than they are worth: every step of Spark ML is a job over them, or several."""
        entries = self.tfidf.vocabulary.agg(F.sum("df")).first()[0] or 0
        return self.vectors.coalesce(tasks_for(self.vectors.sparkSession, entries))

    def balanced(self) -> dict[str, float]:
        return {label: self.n_rows / (len(self.labels) * n) for label, n in self.counts}

    def per_label(self, values: dict[str, float]) -> Column:
        pairs = [F.lit(x) for pair in values.items() for x in pair]
        return F.element_at(F.create_map(*pairs), F.col(self.columns.label))

    def classifier(
        self, name: str, matrix: np.ndarray, intercepts, has_probability: bool, hyperparameters: dict[str, str]
    ) -> TextClassifier:
        spark = self.vocabulary.sparkSession
        k, v = matrix.shape
        by_term = pa.table(
            {
                "idx": pa.array(np.arange(v, dtype=np.int32)),
                "weights": pa.ListArray.from_arrays(
                    pa.array(np.arange(0, v * k + 1, k, dtype=np.int32)), pa.array(np.ascontiguousarray(matrix.T).ravel())
                ),
            }
        )
        weights = spark.createDataFrame(by_term)
        terms = materialise(
            self.vocabulary.join(weights, "idx").select("term", "df", "idf", "weights"), "weights"
        )
        return TextClassifier(
            name=name,
            labels=self.labels,
            intercepts=[float(b) for b in intercepts],
            terms=terms,
            n_terms=self.tfidf.n_terms,
            n_docs=self.tfidf.n_docs,
            has_probability=has_probability,
            config=self.tfidf.config,
            columns=self.columns,
            hyperparameters=hyperparameters,
        )


def recipe(loss: str, balanced: bool, c: float, max_iter: int) -> dict[str, str]:
    """What a model was made with, as its metadata has it."""
    return {"loss": loss, "C": str(c), "max_iter": str(max_iter), "class_weight": "balanced" if balanced else "none"}


def logistic_estimator(n_rows: int, c: float = 1.0, max_iter: int = 2000) -> LogisticRegression:
    # Balanced weights add up to the number of rows as well.
    return LogisticRegression(
        featuresCol="features",
        labelCol="y",
        weightCol="w",
        family="multinomial",
        regParam=1.0 / (c * n_rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,  # the default stops before the fourth decimal of the weights stands still
    )


def fit_logistic(
    data: TrainingSet, balanced: bool = False, c: float = 1.0, max_iter: int = 2000
) -> TextClassifier:
    if not data.on_driver:
        return fit_beyond_driver(data, LOGISTIC_BALANCED if balanced else LOGISTIC, LOGISTIC_LOSS, balanced, c)
    weights = data.balanced() if balanced else dict.fromkeys(data.labels, 1.0)
    index = {label: float(i) for i, label in enumerate(data.labels)}
    rows = data.packed.select(
        "features", data.per_label(index).alias("y"), data.per_label(weights).alias("w")
    )
    model = logistic_estimator(data.n_rows, c, max_iter).fit(rows)
    return data.classifier(
        LOGISTIC_BALANCED if balanced else LOGISTIC,
        model.coefficientMatrix.toArray(),
        model.interceptVector.toArray(),
        has_probability=True,
        hyperparameters=recipe("multinomial logistic", balanced, c, max_iter),
    )


def fit_beyond_driver(data: TrainingSet, name: str, loss: Loss, balanced: bool = False, c: float = 1.0) -> TextClassifier:
    """The same optimum with coefficients that stay in tables, for any number of terms."""
    try:
        return fit_term_partitioned(data.in_tables, name, loss, balanced, c)
    finally:
        data.in_tables.close()


def fit_squared_hinge(data: TrainingSet, balanced: bool = False, c: float = 1.0) -> TextClassifier:
    """One class against the rest with the squared hinge loss, intercepts penalised like weights."""
    return fit_beyond_driver(data, SVM_BALANCED if balanced else SVM, SQUARED_HINGE, balanced, c)


def fit_svm(data: TrainingSet, balanced: bool = False, c: float = 1.0, max_iter: int = 100) -> TextClassifier:
    """One class against the rest; with ``balanced`` the positive side carries its class weight.

    A model beyond the driver gets the squared hinge, as the plain one has no gradient to follow there.
    """
    if not data.on_driver:
        return fit_squared_hinge(data, balanced, c)
    positive = data.balanced() if balanced else dict.fromkeys(data.labels, 1.0)
    counts, vectors = dict(data.counts), data.packed

    def fit_one(label: str):
        is_positive = F.col(data.columns.label) == label
        rows = vectors.select(
            "features",
            is_positive.cast("double").alias("y"),
            F.when(is_positive, positive[label]).otherwise(1.0).alias("w"),
        )
        total_weight = positive[label] * counts[label] + data.n_rows - counts[label]
        svm = LinearSVC(
            labelCol="y",
            weightCol="w",
            regParam=1.0 / (c * total_weight),
            standardization=False,
            maxIter=max_iter,
        )
        return svm.fit(rows)

    with ThreadPool(min(len(data.labels), 8)) as pool:
        models = pool.map(inheritable_thread_target(data.vectors.sparkSession)(fit_one), data.labels)
    return data.classifier(
        SVM_BALANCED if balanced else SVM,
        np.vstack([m.coefficients.toArray() for m in models]),
        [m.intercept for m in models],
        has_probability=False,
        hyperparameters=recipe("hinge", balanced, c, max_iter),
    )
