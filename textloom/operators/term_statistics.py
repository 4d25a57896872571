"""Term statistics that add up: a corpus in parts, a new part, a part taken back.

``(term, df, tf)`` with the number of documents is all that a vocabulary needs, and it is additive over disjoint sets of
documents. So the statistics of a whole corpus are those of its parts merged, a new part costs a pass over the
new part only, and held-out statistics are the whole less the part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.operators.tfidf import COUNTS, TfidfConfig, TfidfModel, all_term_statistics, model_of, term_counts_of
from textloom.storage import materialise


def counted(df: DataFrame, config: TfidfConfig = TfidfConfig(), columns: Columns = DEFAULT_COLUMNS, keep: list[str] = ()) -> DataFrame:
    """The documents with their terms counted, stored: id, ``keep`` and an array of ``(term, tf)``.

    Whatever takes documents takes this table as well and reads the counts, so that a text is
    cut into terms once for statistics, features, training and scoring alike.
    """
    rows = df.select(columns.id, *keep, term_counts_of(df, config, columns).alias(COUNTS))
    return materialise(rows, "counted")


@dataclass(frozen=True)
class TermStatistics:
    """``table(term, df, tf)`` over ``n_docs`` documents: all terms, as a bound on the whole says nothing on a part."""

    table: DataFrame
    n_docs: int
    ngram_range: tuple[int, int]

    @classmethod
    def of(cls, df: DataFrame, config: TfidfConfig = TfidfConfig(), columns: Columns = DEFAULT_COLUMNS) -> TermStatistics:
        """One pass over the documents; only partial counts per term are shuffled."""
        stored = materialise(all_term_statistics(df, config, columns), "term-statistics")
        n_docs = stored.filter(F.col("term").isNull()).select("df").first()
        return cls(stored.filter(F.col("term").isNotNull()), n_docs[0] if n_docs else 0, tuple(config.ngram_range))

    def _plus(self, other: TermStatistics, sign: int) -> TermStatistics:
        if self.ngram_range != other.ngram_range:
            raise ValueError(f"statistics of {self.ngram_range}-grams and {other.ngram_range}-grams do not add up")
        theirs = other.table.select("term", *[(F.col(c) * sign).alias(c) for c in ("df", "tf")])
        summed = self.table.select("term", "df", "tf").unionByName(theirs)
        summed = summed.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
        wrong = F.raise_error(F.concat(F.lit("taken back but never counted: "), "term")).cast("boolean")
        left = F.when((F.col("df") < 0) | (F.col("tf") < 0), wrong).otherwise(F.col("df") > 0)
        if self.n_docs + sign * other.n_docs < 0:
            raise ValueError("more documents taken back than were counted")
        return TermStatistics(materialise(summed.filter(left), "term-statistics"), self.n_docs + sign * other.n_docs, self.ngram_range)

    def merge(self, other: TermStatistics) -> TermStatistics:
        """The statistics of both sets of documents, which share none."""
        return self._plus(other, 1)

    def subtract(self, other: TermStatistics) -> TermStatistics:
        """The statistics without a set of documents that were counted; an error if they were not."""
        return self._plus(other, -1)

    def fit(self, config: TfidfConfig = TfidfConfig(), columns: Columns = DEFAULT_COLUMNS) -> TfidfModel:
        """The vocabulary that :func:`fit_tfidf` learns from the same documents."""
        if tuple(config.ngram_range) != self.ngram_range:
            raise ValueError(f"statistics of {self.ngram_range}-grams cannot make a vocabulary of {config.ngram_range}-grams")
        return model_of(self.table, self.n_docs, config, columns)

    def save(self, path: str) -> None:
        spark = self.table.sparkSession
        low, high = self.ngram_range
        # The bounds travel with every row of the other part, so that one table is the whole artifact.
        head = spark.createDataFrame([(None, self.n_docs, low * 1_000 + high)], "term string, df long, tf long")
        self.table.select("term", "df", "tf").unionByName(head).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermStatistics:
        table = spark.read.schema("term string, df long, tf long").parquet(path)
        head = table.filter(F.col("term").isNull()).first()
        return cls(table.filter(F.col("term").isNotNull()), head.df, divmod(head.tf, 1_000))
