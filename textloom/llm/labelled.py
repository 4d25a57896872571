"""Labels of documents: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a label is for testing only: by the CRC-32 of the id as text. A missing id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(labels: DataFrame, label: str, per_label: int, id_column: str = "doc_id") -> tuple[DataFrame, float]:
    """``(doc_id, label)`` of at most ``per_label`` training rows for each label, and the share of label 1 in all of them.

    Rows are taken in the order of a hash of the id. Several labels of one id count by
    their mean; null labels and ids do not count. Without labels the share is 0.5.
    """
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).alias("label")).dropna()
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    share = known.agg(F.avg("label")).first()[0]
    parts = [known.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for v in (0, 1)]
    rows = [tuple(r) for part in parts for r in part.collect()]  # at most two times per_label pairs of numbers
    return labels.sparkSession.createDataFrame(rows, "doc_id long, label int"), 0.5 if share is None else float(share)
