"""Scoring with several models of one vocabulary at once.

The models' weights of a term stand side by side in one table, so a document's terms are looked up
once and all class sums of all models come out of one aggregate. The sums, a row of numbers per
document, are stored; every model reads its own from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.classifier import TextClassifier
from textloom.storage import materialise


class FusedClassifiers:
    """Models with the same terms, weighting and columns, as candidates on one training side have."""

    def __init__(self, models: Sequence[TextClassifier]):
        first = models[0]
        for model in models[1:]:
            if not shares_vocabulary(first, model):
                raise ValueError(f"{model.name} and {first.name} do not share a vocabulary")
        self.models = list(models)
        terms = first.terms.select("term", "df", "idf", F.col("weights").alias("_w0"))
        for i, model in enumerate(models[1:], 1):
            terms = terms.join(model.terms.select("term", F.col("weights").alias(f"_w{i}")), "term")
        side_by_side = F.concat(*[f"_w{i}" for i in range(len(models))]).alias("weights")
        self._wide = replace(
            first,
            name="fused",
            labels=[f"{i}:{label}" for i, m in enumerate(models) for label in m.labels],
            intercepts=[b for m in models for b in m.intercepts],
            terms=materialise(terms.select("term", "df", "idf", side_by_side), "fused-weights"),
        )

    def sums(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        """One row per document with the class sums of all models, stored."""
        wide, keep = self._wide, list(keep)
        grouped = wide.weighted_terms(df, keep).groupBy(wide.columns.id, *keep)
        return materialise(grouped.agg(*wide._sums()), "fused-sums")

    def predict(self, df: DataFrame, keep: list[str] = ()) -> list[DataFrame]:
        """What each model's own ``predict`` returns, out of one reading of ``df``."""
        keep, sums = list(keep), self.sums(df, keep)
        out, at = [], 0
        for model in self.models:
            own = [F.col(f"_s{at + k}").alias(f"_s{k}") for k in range(len(model.labels))]
            mine = sums.select(model.columns.id, *keep, "_squares", "features_present_count", *own)
            out.append(model._finish(model._with_ranking(mine), keep))
            at += len(model.labels)
        return out

    def confusion_counts(self, df: DataFrame) -> DataFrame:
        """``model, actual, predicted, n`` for the pairs that occur, stored; ``model`` is the position in the list."""
        label = self.models[0].columns.label
        pairs = None
        for i, predictions in enumerate(self.predict(df, [label])):
            some = predictions.select(F.lit(i).alias("model"), F.col(label).alias("actual"), F.col("predicted_label").alias("predicted"))
            pairs = some if pairs is None else pairs.unionByName(some)
        return materialise(pairs.groupBy("model", "actual", "predicted").agg(F.count(F.lit(1)).alias("n")), "fused-counts")


def shares_vocabulary(a: TextClassifier, b: TextClassifier) -> bool:
    """Same weighting, columns and number of terms and documents: made from one vocabulary."""
    return (a.config, a.columns, a.n_terms, a.n_docs) == (b.config, b.columns, b.n_terms, b.n_docs)
