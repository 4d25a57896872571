"""Column names and schemas of the tables that pass between the stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table layouts.
CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("Text", T.StringType()),
        T.StructField("Label", T.StringType()),
        T.StructField("Original_Label", T.StringType()),
    ]
)
PREPARED_COLUMNS = ["ID", "Text", "Cleaned_Text", "Label", "Original_Label"]
METRIC_COLUMNS = [
    "Model",
    "Accuracy",
    "Macro_Precision",
    "Macro_Recall",
    "Macro_F1",
    "Weighted_Precision",
    "Weighted_Recall",
    "Weighted_F1",
    "Training_Time",
    "Prediction_Time",
    "Supports_Proba",
]


@dataclass(frozen=True)
class Columns:
    """Which columns of a corpus play which role."""

    id: str = "ID"
    text: str = "Text"
    cleaned: str = "Cleaned_Text"
    label: str = "Label"


DEFAULT_COLUMNS = Columns()


def text_column(names: list[str]) -> str:
    """The raw text column: ``Text`` where it exists, else ``Headline``."""
    for name in ("Text", "Headline"):
        if name in names:
            return name
    raise ValueError(f"no text column among {names}")
