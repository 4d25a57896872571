"""A fitted linear classifier over TF-IDF terms, and scoring with it.

Naive Bayes, logistic regression and linear SVMs all end up as the same thing:
one row per term with its idf and one weight per class. Scoring joins a
document's terms to that table and sums. The unit length of the TF-IDF row is a
common factor of the sums, so it is applied after the aggregation: what leaves a
map task is one row of sums per document, never its terms.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.functions.profile import percentage
from textloom.functions.text import let
from textloom.operators.tfidf import TfidfConfig, by_document, known_rows
from textloom.sizing import MAX_CLASSES, bounded_collect, per_class_table

DISCLAIMER = (
    "Terms with the highest TF-IDF contributions to the predicted class in this text; "
    "they show which terms moved the model score most, not why the text was written."
)


def _softmax(margins: Column) -> Column:
    def shifted(m: Column) -> Column:
        return let(F.array_max(m), lambda top: F.transform(m, lambda z: F.exp(z - top)))

    def scaled(e: Column) -> Column:
        return let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total))

    return let(margins, lambda m: let(shifted(m), scaled))


@dataclass(frozen=True)
class TextClassifier:
    """``terms`` has one row per term: ``term, df, idf, weights``, the weights in the order of ``labels``."""

    name: str
    labels: list[str]
    intercepts: list[float]
    terms: DataFrame
    n_terms: int
    n_docs: int
    has_probability: bool
    config: TfidfConfig
    columns: Columns = DEFAULT_COLUMNS
    hyperparameters: dict[str, str] = field(default_factory=dict)

    def weighted_terms(self, df: DataFrame, keep: list[str]) -> DataFrame:
        known = known_rows(df, self.terms, self.config, self.columns, keep, outer=True)
        return known.withColumn("raw", self.config.term_weight() * F.col("idf"))

    def _sums(self) -> list[Column]:
        per_class = [F.sum(F.col("raw") * F.get("weights", F.lit(i))).alias(f"_s{i}") for i in range(len(self.labels))]
        return [F.sum(F.col("raw") * F.col("raw")).alias("_squares"), F.count("raw").alias("features_present_count"), *per_class]

    def _with_ranking(self, sums: DataFrame) -> DataFrame:
        """From the per-document sums to ``margins`` and the classes in order.

        Equal scores are ordered by label.
        """
        length = F.sqrt("_squares")
        margins = [
            F.lit(float(b)) + F.coalesce(F.col(f"_s{i}") / length, F.lit(0.0)) for i, b in enumerate(self.intercepts)
        ]
        scored = sums.withColumn("margins", F.array(*margins)).drop("_squares", *[f"_s{i}" for i in range(len(self.labels))])
        if self.has_probability:
            scored = scored.withColumn("_score", _softmax(F.col("margins")))
        else:
            scored = scored.withColumn("_score", F.col("margins"))
        entries = [
            F.struct((-F.get("_score", F.lit(i))).alias("down"), F.lit(label).alias("label"), F.lit(i).alias("at"))
            for i, label in enumerate(self.labels)
        ]
        return scored.withColumn("_ranked", F.sort_array(F.array(*entries))).drop("_score")

    def predict(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        """One row per document: id, ``keep``, the label, its probability, all classes ranked.

        ``keep`` is for small columns that travel along, such as the true label.
        Models without probabilities give NULL ones. Rows of one id are one document;
        :mod:`textloom.plans.scoring` scores tables whose ids repeat or are missing.
        """
        keep = list(keep)
        sums = self.weighted_terms(df, keep).groupBy(self.columns.id, *keep).agg(*self._sums())
        return self._finish(self._with_ranking(sums), keep)

    def _finish(self, ranked: DataFrame, keep: list[str], *extra: str) -> DataFrame:
        def probability(entry: Column) -> Column:
            return -entry["down"] if self.has_probability else F.lit(None).cast("double")

        ranking = F.transform(
            "_ranked", lambda e: F.struct(e["label"].alias("label"), probability(e).alias("probability"))
        )
        best = F.get("_ranked", F.lit(0))
        return ranked.select(
            self.columns.id,
            *keep,
            best["label"].alias("predicted_label"),
            probability(best).alias("predicted_probability"),
            ranking.alias("ranking"),
            "margins",
            "features_present_count",
            *extra,
        )

    def explain(self, df: DataFrame, top_n: int = 5, keep: list[str] = ()) -> DataFrame:
        """Predictions plus term contributions ``tfidf * weight`` for the predicted class.

        Texts are spread by id first; a document's own terms then meet in one row
        together with its sums, and the text is scored once for both purposes.
        """
        keep = list(keep)
        placed = by_document(df, self.columns, keep)
        known = F.when(F.col("raw").isNotNull(), F.struct("term", "raw", "weights"))
        sums = (
            self.weighted_terms(placed, keep)
            .groupBy(self.columns.id, *keep)
            .agg(*self._sums(), F.collect_list(known).alias("_terms"))
            .withColumn("_length", F.sqrt("_squares"))
        )
        ranked = self._with_ranking(sums)
        document = F.struct(F.col("_length").alias("length"), F.get("_ranked", F.lit(0))["at"].alias("at"))

        def entry(t: Column, of: Column) -> Column:
            tfidf = t["raw"] / of["length"]
            weight = F.get(t["weights"], of["at"])
            contribution = tfidf * weight
            return F.struct(
                (-F.round(contribution, 4)).alias("down"),
                t["term"].alias("term"),
                F.round(contribution, 4).alias("contribution"),
                F.round(tfidf, 4).alias("tfidf"),
                F.round(weight, 4).alias("coefficient"),
                (contribution >= 0).alias("is_positive"),
            )

        def shown(e: Column) -> Column:
            fields = ("term", "contribution", "tfidf", "coefficient", "is_positive")
            return F.struct(*[e[f].alias(f) for f in fields])

        # Bound once per document; a lambda would evaluate the ranking again for every term.
        contributions = let(document, lambda of: F.transform("_terms", lambda t: entry(t, of)))
        ordered = F.transform(F.sort_array(contributions), shown)
        positive = F.filter("all_present_features", lambda e: e["contribution"] > 0)
        return (
            self._finish(ranked.withColumn("all_present_features", ordered), keep, "all_present_features")
            .withColumn("_positive", positive)
            .withColumn(
                "top_contributing_features",
                F.slice(
                    F.when(F.size("_positive") > 0, F.col("_positive")).otherwise(F.col("all_present_features")), 1, top_n
                ),
            )
            .drop("_positive")
        )

    def present(self, predictions: DataFrame, top_k: int = 3) -> DataFrame:
        """Rounded numbers, the top classes and all classes, as people read them."""

        def rounded(e: Column) -> Column:
            return F.struct(
                e["label"].alias("label"),
                F.round(e["probability"], 4).alias("probability"),
                percentage(e["probability"]).alias("percentage"),
            )

        classes = F.transform("ranking", lambda e: F.struct(e["label"].alias("key"), F.round(e["probability"], 4).alias("value")))
        return (
            predictions.withColumn("top_predictions", F.transform(F.slice("ranking", 1, top_k), rounded))
            .withColumn("all_class_probabilities", F.map_from_entries(classes))
            .withColumn("confidence_percentage", percentage(F.col("predicted_probability")))
            .withColumn("predicted_probability", F.round("predicted_probability", 4))
        )

    def top_terms(self, top_n: int = 20) -> DataFrame:
        """The ``top_n`` terms with the highest weight per class: ``Class, Rank, Feature, Coefficient``."""
        pairs = F.array(
            *[F.struct(F.lit(label).alias("Class"), F.get("weights", F.lit(i)).alias("w")) for i, label in enumerate(self.labels)]
        )
        order = Window.partitionBy("Class").orderBy(F.desc("w"), F.asc("Feature"))
        return (
            self.terms.select(F.col("term").alias("Feature"), F.inline(pairs))
            .withColumn("Rank", F.row_number().over(order))
            .filter(F.col("Rank") <= top_n)
            .select("Class", "Rank", "Feature", F.round("w", 4).alias("Coefficient"))
        )


def class_counts(train: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> list[tuple[str, int]]:
    """Labels in alphabetical order with their rows; the driver gets one row per class."""
    counts = train.groupBy(F.col(columns.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = bounded_collect(counts, MAX_CLASSES, "labels")
    if any(r["label"] is None for r in rows):
        raise ValueError("training rows without a label")
    return sorted((r["label"], r["n"]) for r in rows)


def with_label_index(df: DataFrame, labels: list[str], columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Adds ``label_index``, the position in the alphabetical class list; NULL for other labels."""
    pairs = [F.lit(x) for i, label in enumerate(sorted(labels)) for x in (label, i)]
    return df.withColumn("label_index", F.try_element_at(F.create_map(*pairs), F.col(columns.label)))


def class_weights(df: DataFrame, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Balanced class weights ``n / (K * n_c)``, one row per label."""
    counts = df.groupBy(F.col(columns.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total, classes = F.sum("n").over(per_class_table()), F.count(F.lit(1)).over(per_class_table())
    return counts.select("label", "n", (total / (classes * F.col("n"))).alias("weight"))
