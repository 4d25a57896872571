"""Classify texts as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.classifier import TextClassifier
from textloom.plans.scoring import score_batch
from textloom.storage import scope

PAYLOAD_SCHEMA = "headline string"


def parse_payload(stream: DataFrame, payload: str = "value", text: str = "Text") -> DataFrame:
    """The text out of ``{"headline": ...}``; a payload that is not such a record gives NULL,
    which scoring reports as an error."""
    parsed = F.from_json(F.col(payload).cast("string"), PAYLOAD_SCHEMA)
    return stream.withColumn(text, parsed["headline"])


def start_scoring(
    classifier: TextClassifier,
    stream: DataFrame,
    output: str,
    checkpoint: str,
    top_k: int = 3,
    available_now: bool = False,
) -> StreamingQuery:
    """Score every micro-batch with the batch plan and append the records as Parquet.

    A batch owns one folder and overwrites it when it is replayed after a
    failure, so no record is lost or doubled. Batch numbers start over with a new
    checkpoint, so the folder is named after the query id too, which Spark keeps in the checkpoint: a
    query started afresh on the same output, even in a checkpoint folder of the same name, adds
    to it. What a batch stores on the way is deleted when its records are written. The
    work keeps no state.
    """
    spark = stream.sparkSession
    names: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not names:
            names.append(spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id.replace("-", ""))
        with scope(spark, f"stream-{names[0]}-{batch_id}"):
            path = f"{output}/run=r{names[0]}/batch_id={batch_id}"
            score_batch(classifier, batch, top_k).write.mode("overwrite").parquet(path)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
