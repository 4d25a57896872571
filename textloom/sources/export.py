"""Predictions in the layout people download."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.profile import percentage
from textloom.sources.corpus import BYTE_ORDER_MARK

# Report columns.
REPORT_COLUMNS = ["Headline", "Predicted Category", "Model Probability", "Top 1", "Top 2", "Top 3", "Timestamp"]


def prediction_report(scored: DataFrame, text: str = "Text", at: Column | None = None) -> DataFrame:
    """One report row per scored text; texts with an error have none."""

    def ranked(i: int) -> Column:
        entry = F.get("top_predictions", F.lit(i))
        shown = F.concat(entry["label"], F.lit(" ("), percentage(entry["probability"]), F.lit(")"))
        return F.coalesce(shown, F.lit(""))

    at = F.current_timestamp() if at is None else at
    values = [
        F.col(text),
        F.col("predicted_label"),
        percentage(F.col("predicted_probability")),
        *[ranked(i) for i in range(3)],
        F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    ]
    return scored.filter(F.col("error").isNull()).select(
        *[value.alias(name) for value, name in zip(values, REPORT_COLUMNS)]
    )


def write_prediction_report(report: DataFrame, path: str) -> None:
    """CSV with all values quoted and quotes doubled. Every file starts with a byte-order mark
    and the header, as spreadsheet programs expect; Spark's CSV writer would quote the mark."""
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in report.columns]
    header = BYTE_ORDER_MARK + ",".join(f'"{c}"' for c in report.columns)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

    lines = report.select(F.concat_ws(",", *quoted).alias("value"))
    lines.mapInArrow(headed, "value string").write.mode("overwrite").text(path)
