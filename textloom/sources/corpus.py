"""Corpus tables in CSV and Parquet, and the stored train/test tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.columns import CORPUS_SCHEMA, DEFAULT_COLUMNS, PREPARED_COLUMNS, Columns

SPLITS = ("train", "test")
# Excel-style UTF-8: the mark before the first header name.
BYTE_ORDER_MARK = "\ufeff"


CORRUPT = "_corrupt_record"
# Text that one task cleans and takes apart.
TASK_TEXT_BYTES = 8 * 1024 * 1024


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = CORPUS_SCHEMA, multiline: bool = True, keep_corrupt: bool = False
) -> DataFrame:
    """A CSV with header, doubled quotes and perhaps a byte-order mark.

    Columns are found by their names in the header, in whatever order; a column the file
    lacks is an error, as is a missing path. ``keep_corrupt`` adds ``_corrupt_record`` with
    the line of every row whose values do not fit the schema (its bad values are NULL), so
    that an audit can count them. With ``multiline`` values may hold line breaks, and each
    file is one task; without it, large files are split. For large files whose values hold line
    breaks there is :func:`textloom.sources.quoted_csv.read_quoted_csv`.
    """
    fields, kept = csv_fields(spark, path, schema, multiline, keep_corrupt)
    reader = _reader(spark, multiline).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(T.StructType(fields)).option("enforceSchema", True).csv(path).select(*kept)


def _reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)


def csv_fields(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool, keep_corrupt: bool
) -> tuple[list[T.StructField], list[str]]:
    """The fields in the order of the header, other columns as text, and the names to keep."""
    header = [name.removeprefix(BYTE_ORDER_MARK) for name in _reader(spark, multiline).csv(path).columns]
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    fields = {f.name: f for f in schema.fields}
    found = [fields.get(name, T.StructField(name, T.StringType())) for name in header]
    if keep_corrupt:
        return [*found, T.StructField(CORRUPT, T.StringType())], [*schema.names, CORRUPT]
    return found, list(schema.names)


def read_parquet(spark: SparkSession, path: str, mapping: dict[str, str], spread_by: str | None = None) -> DataFrame:
    """A Parquet table under corpus names; ``mapping`` goes from corpus name to stored name.

    With ``spread_by`` a file of a few large row groups is handed to all cores.
    A table that already has a partition per core is read as it lies.
    """
    table = spark.read.parquet(path).select(*[F.col(stored).alias(name) for name, stored in mapping.items()])
    return table if spread_by is None else spread(table, spread_by)


def spread(scan: DataFrame, by: str) -> DataFrame:
    """Text work costs far more than moving the text, and a text becomes some thirty times its size in terms. So a scan with
    fewer partitions than cores, or than its text has pieces of ``TASK_TEXT_BYTES``, is spread by hash first. The text is
    measured as it is read, since stored sizes say little of texts that compress well."""
    partitions, cores = scan.rdd.getNumPartitions(), scan.sparkSession.sparkContext.defaultParallelism
    texts = [F.octet_length(name) for name, kind in scan.dtypes if kind == "string"]
    size = scan.agg(F.sum(sum((F.coalesce(x, F.lit(0)).cast("long") for x in texts), F.lit(0)))).first()[0] or 0
    wanted = math.ceil(size / TASK_TEXT_BYTES)
    if partitions >= max(cores, wanted):
        return scan
    return scan.repartition(max(2 * cores, wanted), by)


def with_mark(df: DataFrame) -> DataFrame:
    """The first column's name starts with the mark, so every written file does."""
    return df.withColumnRenamed(df.columns[0], BYTE_ORDER_MARK + df.columns[0])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV whose files start with a byte-order mark, as spreadsheet programs expect."""
    with_mark(df).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def _split_columns(df: DataFrame) -> list[str]:
    return [c for c in PREPARED_COLUMNS if c in df.columns]


def write_splits(df: DataFrame, path: str, split: str = "split", as_csv: bool = False) -> None:
    """The corpus columns under ``split=train`` and ``split=test``, in one pass over the rows."""
    rows = df.select(*_split_columns(df), F.col(split).alias("split"))
    if as_csv:
        writer = with_mark(rows).write.option("header", True).option("escape", '"').option("emptyValue", "")
        writer.mode("overwrite").partitionBy("split").csv(path)
    else:
        rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(
    spark: SparkSession, path: str, side: str, columns: Columns = DEFAULT_COLUMNS, as_csv: bool = False
) -> DataFrame:
    """Id, cleaned text and label of one side; Parquet reads just these."""
    folder = f"{path}/split={side}"
    if as_csv:
        fields = {f.name: f for f in CORPUS_SCHEMA.fields}
        wanted = (columns.id, columns.cleaned, columns.label)
        schema = T.StructType([fields.get(c, T.StructField(c, T.StringType())) for c in wanted])
        table = read_csv(spark, folder, schema)
    else:
        table = spark.read.parquet(folder)
    return table.select(columns.id, columns.cleaned, columns.label)


def verify_splits(df: DataFrame, path: str, split: str = "split") -> DataFrame:
    """Re-read what was written: rows and columns per side against the source."""
    table = df.sparkSession.read.parquet(path)
    columns_match = set(table.columns) == {*_split_columns(df), "split"}
    expected = df.groupBy(F.col(split).alias("split")).agg(F.count(F.lit(1)).alias("expected_rows"))
    written = table.groupBy("split").agg(F.count(F.lit(1)).alias("written_rows"))
    zero = F.lit(0).cast("long")
    return (
        expected.join(written, "split", "full_outer")
        .withColumns({c: F.coalesce(c, zero) for c in ("expected_rows", "written_rows")})
        .select(
            "split",
            "expected_rows",
            "written_rows",
            F.lit(columns_match).alias("columns_match"),
            (F.col("expected_rows") == F.col("written_rows")).alias("rows_match"),
        )
    )


def write_report(df: DataFrame, path: str) -> None:
    """A report table (metrics, errors, top terms) as CSV."""
    write_csv(df, path)
