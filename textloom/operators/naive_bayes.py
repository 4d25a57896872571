"""Multinomial naive Bayes on TF-IDF values, as aggregates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.operators.classifier import TextClassifier, class_counts
from textloom.operators.tfidf import TfidfConfig, TfidfModel, fit_tfidf
from textloom.storage import materialise

NAME = "Multinomial Naive Bayes"


def fit_naive_bayes(
    train: DataFrame,
    config: TfidfConfig = TfidfConfig(),
    columns: Columns = DEFAULT_COLUMNS,
    alpha: float = 1.0,
    tfidf: TfidfModel | None = None,
) -> TextClassifier:
    """Class priors from row counts, term likelihoods from summed TF-IDF with additive smoothing.

    One aggregate by term holds all classes side by side; its partial sums are
    folded before the shuffle, so neither a frequent term nor a big class piles up.
    """
    tfidf = tfidf or fit_tfidf(train, config, columns)
    counts = class_counts(train, columns)
    labels = [label for label, _ in counts]
    n_rows = sum(n for _, n in counts)
    sums = [
        F.coalesce(F.sum(F.when(F.col(columns.label) == label, F.col("tfidf"))), F.lit(0.0)).alias(f"s{i}")
        for i, label in enumerate(labels)
    ]
    per_term = materialise(
        tfidf.transform(train, keep=[columns.label]).groupBy("term").agg(F.max("df").alias("df"), *sums),
        "class-sums",
    )
    totals = per_term.agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(labels))]).first()
    weights = F.array(
        *[
            F.log((F.col(f"s{i}") + alpha) / F.lit((totals[f"s{i}"] or 0.0) + alpha * tfidf.n_terms))
            for i in range(len(labels))
        ]
    )
    terms = per_term.select("term", "df", tfidf.config.idf(tfidf.n_docs).alias("idf"), weights.alias("weights"))
    return TextClassifier(
        name=NAME,
        labels=labels,
        intercepts=[math.log(n / n_rows) for _, n in counts],
        terms=terms,
        n_terms=tfidf.n_terms,
        n_docs=tfidf.n_docs,
        has_probability=True,
        config=tfidf.config,
        columns=columns,
        hyperparameters={"alpha": str(alpha)},
    )
