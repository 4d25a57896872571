"""Fitted classifiers as tables: ``terms``, ``classes`` and a JSON ``metadata`` row, in versions.

Every save is a folder of its own under ``versions``. The last step of a save makes an empty file under ``published``
whose name is ``<number>-<version>``; the greatest name is the current model. The name is the whole pointer, so a reader
sees the model before or the model after, never parts of both, and a save that was cut off is not seen at all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.columns import Columns
from textloom.functions.text import TOKEN_PATTERN
from textloom.operators.classifier import TextClassifier
from textloom.operators.tfidf import TfidfConfig
from textloom.storage import delete_folder, list_names, make_file

_CLASS_SCHEMA = "position int, label string, intercept double"
_METADATA_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("ngram_range", T.ArrayType(T.IntegerType())),
        T.StructField("min_df", T.StringType()),
        T.StructField("max_df", T.StringType()),
        T.StructField("sublinear_tf", T.BooleanType()),
        T.StructField("use_idf", T.BooleanType()),
        T.StructField("max_features", T.LongType()),
        T.StructField("has_probability", T.BooleanType()),
        T.StructField("training_documents", T.LongType()),
        T.StructField("vocabulary_size", T.LongType()),
        T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
        T.StructField("evaluation", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("per_class_f1", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("per_class_recall", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("test_documents", T.LongType()),
        T.StructField("token_pattern", T.StringType()),
        T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _bound(text: str) -> int | float:
    return float(text) if "." in text or "e" in text else int(text)


@dataclass(frozen=True)
class Measured:
    """What was measured of a model on how many held-out documents, if anything."""

    metrics: dict[str, float] = field(default_factory=dict)
    per_class_f1: dict[str, float] = field(default_factory=dict)
    per_class_recall: dict[str, float] = field(default_factory=dict)
    test_documents: int | None = None


def metadata_row(classifier: TextClassifier, measured: Measured = Measured()) -> DataFrame:
    """Everything about the model that is not a term: how it was made and what was measured."""
    config = classifier.config
    row = (
        classifier.name,
        classifier.labels,
        list(config.ngram_range),
        str(config.min_df),
        str(config.max_df),
        config.sublinear_tf,
        config.use_idf,
        config.max_features,
        classifier.has_probability,
        classifier.n_docs,
        classifier.n_terms,
        {k: getattr(classifier.columns, k) for k in ("id", "text", "cleaned", "label")},
        measured.metrics,
        measured.per_class_f1,
        measured.per_class_recall,
        measured.test_documents,
        TOKEN_PATTERN,
        classifier.hyperparameters,
    )
    return classifier.terms.sparkSession.createDataFrame([row], _METADATA_SCHEMA)


def save_classifier(classifier: TextClassifier, path: str, measured: Measured = Measured()) -> str:
    """Store a new version, publish it, return its name. Versions before it stay as they are."""
    spark = classifier.terms.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    classifier.terms.write.parquet(f"{folder}/terms")
    classes = [(i, label, b) for i, (label, b) in enumerate(zip(classifier.labels, classifier.intercepts))]
    spark.createDataFrame(classes, _CLASS_SCHEMA).write.parquet(f"{folder}/classes")
    metadata_row(classifier, measured).coalesce(1).write.json(f"{folder}/metadata")
    publish(spark, path, version)
    return version


def publications(spark: SparkSession, path: str) -> list[str]:
    """The published versions, oldest publication first; one that was published again is there again."""
    return [name.partition("-")[2] for name in list_names(spark, f"{path}/published")]


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a stored version the current one, be it new or an earlier one to go back to.

    Two that are published at once may get one number; all readers then agree on the greater name.
    """
    if version not in list_names(spark, f"{path}/versions"):
        raise ValueError(f"no version {version} at {path}")
    last = max((int(name.partition("-")[0]) for name in list_names(spark, f"{path}/published")), default=0)
    make_file(spark, f"{path}/published/{last + 1:012d}-{version}")


def current_version(spark: SparkSession, path: str) -> str:
    published = publications(spark, path)
    if not published:
        raise ValueError(f"no classifier at {path}")
    return published[-1]


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` versions published last, and return which.

    Pointers go first, so that nobody starts to read what is being deleted; whoever holds a dropped model
    cannot go on with it. Folders that were never published stay, as they may be saves under way.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    names = list_names(spark, f"{path}/published")
    newest_first = list(dict.fromkeys(name.partition("-")[2] for name in reversed(names)))
    dropped = newest_first[keep:]
    for name in names:
        if name.partition("-")[2] in dropped:
            delete_folder(spark, f"{path}/published/{name}")
    for version in dropped:
        delete_folder(spark, f"{path}/versions/{version}")
    return dropped


def read_metadata(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    version = version or current_version(spark, path)
    return spark.read.schema(_METADATA_SCHEMA).json(f"{path}/versions/{version}/metadata")


def load_classifier(spark: SparkSession, path: str, version: str | None = None) -> TextClassifier:
    """The current version, or the one named. Fails when any of the three parts is missing.

    All parts are read from one version, also while another is being saved.
    """
    version = version or current_version(spark, path)
    folder = f"{path}/versions/{version}"
    terms = spark.read.parquet(f"{folder}/terms")
    classes = spark.read.schema(_CLASS_SCHEMA).parquet(f"{folder}/classes").orderBy("position").collect()
    meta = read_metadata(spark, path, version).first()
    if meta is None or not classes:
        raise ValueError(f"incomplete classifier at {folder}")
    low, high = meta["ngram_range"]
    config = TfidfConfig(
        (low, high),
        _bound(meta["min_df"]),
        _bound(meta["max_df"]),
        meta["sublinear_tf"],
        meta["use_idf"],
        meta["max_features"],
    )
    return TextClassifier(
        name=meta["model"],
        labels=[r["label"] for r in classes],
        intercepts=[r["intercept"] for r in classes],
        terms=terms,
        n_terms=meta["vocabulary_size"],
        n_docs=meta["training_documents"],
        has_probability=meta["has_probability"],
        config=config,
        columns=Columns(**meta["columns"]),
        hyperparameters=meta["hyperparameters"],
    )


def vocabulary(classifier: TextClassifier) -> DataFrame:
    return classifier.terms.select("term", "df", "idf")


def coefficients(classifier: TextClassifier) -> DataFrame:
    """Long form: ``label, term, weight``."""
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.get("weights", F.lit(i)).alias("weight"))
            for i, label in enumerate(classifier.labels)
        ]
    )
    return classifier.terms.select("term", F.inline(pairs)).select("label", "term", "weight")
