"""Line dedup: levelled sorted runs of line hashes.

Lines are taken in batches of documents, the largest ids first. A batch's line table (one
row per line) merge-anti-joins the runs stored so far: lines in none of them are new and
get the batch's largest id as their holder, the others add to the count only. The batch
becomes a run of level 0. As soon as a level holds ``fanout`` runs, they are merged into
one run of the next level, so a line is rewritten once per level and a batch is compared
to few runs. Runs are bucketed and sorted by line, so joining them moves only the batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import BLANKS, NO_ID, ascii_lower, null_safe, text_digest
from textloom.storage import materialise, new_path


def lines_of(text: Column) -> Column:
    """Null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """An index of lines that grows by batches: ``(line, documents, holder)`` in levelled sorted runs."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark = spark
        self.fanout = fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _store(self, rows: DataFrame) -> str:
        name = f"textloom_run_{uuid.uuid4().hex}"
        (
            rows.select("line", "documents", "holder")
            .repartition(self.buckets, "line")
            .write.format("parquet")
            .bucketBy(self.buckets, "line")
            .sortBy("line")
            .option("path", new_path(self.spark, "line-run"))
            .saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's lines that no run holds."""
        for run in self.runs():
            batch = batch.join(run.select("line").hint("merge"), "line", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """``batch(line, documents, holder)`` with one row per line. The holder of a line
        that an earlier batch had stays as it is."""
        batch = materialise(batch, "line-batch")
        new = materialise(self.unseen(batch), "line-new")
        seen = batch.join(new.select("line").hint("merge"), "line", "left_anti").withColumn("holder", F.lit(None).cast("long"))
        self._place(0, self._store(new.unionByName(seen)))

    def _place(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = self._store(_merged([self.spark.table(n) for n in self.levels[level]]))
            for old in self.levels[level]:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []
            self._place(level + 1, merged)

    def index(self) -> DataFrame:
        """All runs as one table with one row per line."""
        return _merged(self.runs())

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _merged(runs: list[DataFrame]) -> DataFrame:
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.unionByName(run)
    return rows.groupBy("line").agg(F.sum("documents").alias("documents"), F.max("holder").alias("holder"))


def drop_repeated_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = 3,
    min_chars: int = 20,
    batches: int = 4,
) -> DataFrame:
    """Drop lines that ``min_documents`` documents hold, except where the largest id holds them.

    Returns ``row`` (the input row as a struct), ``doc_id``, ``n_lines``, ``n_dropped`` and
    ``kept_text``, one row per input row. Lines are compared without the blanks at both
    ends and in lower case (A-Z); keys under ``min_chars`` code points never go.

    Defined cases: a null or empty text is one empty line. Rows of one id are one document,
    so all copies of a holder keep the line. A null id counts as the smallest. An empty
    table gives an empty table. Other columns, whatever their names, stay in ``row``.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("_text"),
    )
    order = F.coalesce("doc_id", F.lit(NO_ID))
    cuts = rows.agg(F.percentile_approx(order, [i / batches for i in range(batches - 1, 0, -1)])).first()[0] or []
    batch = F.lit(0)
    for number, cut in enumerate(cuts, 1):
        batch = F.when(order < cut, number).otherwise(batch)
    lines = rows.select(
        order.alias("id"), text_digest(F.col("_text")).alias("digest"), batch.alias("batch"),
        F.posexplode(lines_of(F.col("_text"))).alias("pos", "text"),
    ).withColumn("text", line_key(F.col("text")))
    lines = lines.filter(F.char_length("text") >= min_chars)
    path = new_path(spark, "lines")
    lines.select("id", "digest", "pos", F.unhex(F.md5("text")).alias("line"), "batch").write.partitionBy("batch").parquet(path)
    schema = "id long, digest binary, pos int, line binary, batch int"
    stored = spark.read.schema(schema).parquet(path)

    runs = LineRuns(spark)
    try:
        for number in range(len(cuts) + 1):
            pairs = stored.filter(F.col("batch") == number).select("line", "id").distinct()
            counted = pairs.groupBy("line").agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("holder"))
            runs.add(counted)
        repeated = materialise(runs.index().filter(F.col("documents") >= min_documents), "repeated-lines")
    finally:
        runs.close()

    dropped = (
        stored.join(repeated.select("line", "holder"), "line")
        .filter(F.col("id") != F.col("holder"))
        .groupBy("id", "digest")
        .agg(F.collect_set("pos").alias("_gone"))
    )
    dropped = materialise(dropped, "dropped-lines")
    keyed = rows.withColumns({"_id": order, "_digest": text_digest(F.col("_text"))})
    joined = keyed.join(
        dropped.toDF("_id", "_digest", "_gone"), ["_id", "_digest"], "left"
    ).withColumn("_lines", lines_of(F.col("_text")))
    positions = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.concat_ws("\n", F.transform(positions, lambda i: F.get(F.col("_lines"), i)))
    return joined.select(
        "row",
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_gone").isNull(), F.coalesce("_text", F.lit(""))).otherwise(kept).alias("kept_text"),
    )


def lines_query(documents: DataFrame) -> DataFrame:
    kept = drop_repeated_lines(documents.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT doc_id, text, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.holder AS gone FROM keyed k LEFT JOIN repeated r ON r.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
