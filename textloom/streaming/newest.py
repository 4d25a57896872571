"""The newest rows of each session, kept while they arrive."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from textloom.storage import delete_folder, list_names, materialise, scope

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _newest_first(values: tuple) -> tuple:
    """Greater is newer; a missing value is older than any."""
    return tuple((value is not None, value) for value in values)


def _thinned(batches: Iterator[pa.RecordBatch], session: str, order: list[str], n: int) -> Iterator[pa.RecordBatch]:
    """At most ``n`` rows of a session out of each Arrow batch: the others cannot be among its newest."""
    for batch in batches:
        if batch.num_rows <= n:
            yield batch
            continue
        codes = batch.column(session).dictionary_encode(null_encoding="encode").indices
        keys = pa.table([codes, *[batch.column(c) for c in order]], names=["s", *[f"o{i}" for i in range(len(order))]])
        by = [("s", "ascending"), *[(f"o{i}", "descending") for i in range(len(order))]]
        ranked = pa.compute.sort_indices(keys, sort_keys=by, null_placement="at_end")
        sorted_codes = codes.take(ranked).to_numpy()
        starts = np.flatnonzero(np.diff(sorted_codes, prepend=-1))
        position = np.arange(len(sorted_codes)) - np.repeat(starts, np.diff(starts, append=len(sorted_codes)))
        yield batch.take(ranked.filter(pa.array(position < n)))


class _Newest(StatefulProcessor):
    """Keeps a list of at most ``n`` rows of a session and tells it whenever rows came in."""

    def __init__(self, fields: list[str], schema: str, order: list[str], n: int) -> None:
        self.fields, self.schema, self.n = fields, schema, n
        self.order = [fields.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("newest", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        stored = self.kept.get() if self.kept.exists() else ()
        both = chain((tuple(r) for r in stored), (tuple(r[f] for f in self.fields) for r in rows))
        newest = heapq.nlargest(self.n, both, key=lambda r: _newest_first(tuple(r[i] for i in self.order)))
        self.kept.put(newest)
        record = Row(*self.fields, "position")
        for position, row in enumerate(newest, 1):
            yield record(*row, position)

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, session: str, order: list[str], n: int = 20) -> DataFrame:
    """For every session that got rows: its ``n`` newest rows so far, with ``position`` 1 for the newest.

    ``order`` are the columns that tell which is newer, most important first. Rows may arrive late and in any order.
    Tasks send at most ``n`` rows of a session from each Arrow batch, so a session that owns most of the stream is
    no single task's work, and the state is ``n`` rows a session. Missing sessions are one. Needs the RocksDB state
    store and update mode, which :func:`start_newest` sets.
    """
    fields = stream.columns
    thinned = stream.mapInArrow(lambda batches: _thinned(batches, session, order, n), stream.schema)
    output = T.StructType([*stream.schema.fields, T.StructField("position", T.IntegerType())])
    processor = _Newest(fields, stream.schema, order, n)
    return thinned.groupBy(session).transformWithState(processor, output, "Update", "None")


def start_newest(
    stream: DataFrame,
    output: str,
    checkpoint: str,
    session: str,
    order: list[str],
    n: int = 20,
    fold_every: int = 16,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the newest rows of each session in ``output``, to be read with :func:`read_newest`.

    A micro-batch writes the lists of the sessions that it changed into a folder of its own, and overwrites it when
    it is replayed. Every ``fold_every`` batches the folder gets the lists of all sessions, and the folders
    before the last such one go; readers that listed them before have a whole fold's time to finish.
    A query with a new checkpoint adds to the output: its rows count beside those that are there.
    """
    spark = stream.sparkSession
    names: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not names:
            names.append(spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id.replace("-", ""))
        run = f"{output}/run=r{names[0]}"
        folder = f"{run}/batch={batch_id}"
        if batch_id % fold_every < fold_every - 1:
            batch.write.mode("overwrite").parquet(folder)
            return
        with scope(spark, f"newest-{names[0]}-{batch_id}"):
            changed = materialise(batch, "changed")
            before = _lists(spark, run, stream.schema, [k for k in _batches(spark, run) if k < batch_id], session)
            told = changed.select(F.col(session).alias("_told")).distinct()
            rest = before.join(told, F.col(session).eqNullSafe(F.col("_told")), "left_anti")
            changed.unionByName(rest).write.mode("overwrite").parquet(folder)
        for k in _batches(spark, run):
            if k < batch_id - fold_every:
                delete_folder(spark, f"{run}/batch={k}")

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # a query keeps the settings it was started with
    try:
        lists = newest_rows(stream, session, order, n)
        writer = lists.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _batches(spark: SparkSession, run: str) -> list[int]:
    """The finished batches of a run: those whose folder has its success marker."""
    found = [name.removeprefix("batch=") for name in list_names(spark, run) if name.startswith("batch=")]
    return sorted(int(k) for k in found if "_SUCCESS" in list_names(spark, f"{run}/batch={k}"))


def _lists(spark: SparkSession, run: str, schema: T.StructType, batches: list[int], session: str) -> DataFrame:
    """The last list of every session in a run."""
    fields = T.StructType([*schema.fields, T.StructField("position", T.IntegerType())])
    if not batches:
        return spark.createDataFrame([], fields)
    paths = [f"{run}/batch={k}" for k in batches]
    rows = spark.read.schema(T.StructType([*fields, T.StructField("batch", T.LongType())])).option("basePath", run).parquet(*paths)
    last = rows.groupBy(F.col(session).alias("_session")).agg(F.max("batch").alias("_last"))
    on = rows[session].eqNullSafe(F.col("_session")) & (rows["batch"] == F.col("_last"))
    return rows.join(last, on).select(*fields.fieldNames())


def read_newest(spark: SparkSession, output: str, schema: T.StructType, session: str, order: list[str], n: int = 20) -> DataFrame:
    """The ``n`` newest rows of every session with their ``position``, as the stream has kept them up to now."""
    found = _lists(spark, output, schema, [], session)
    for run in (f"{output}/{name}" for name in list_names(spark, output) if name.startswith("run=")):
        found = found.unionByName(_lists(spark, run, schema, _batches(spark, run), session))
    by = Window.partitionBy(session).orderBy(*[F.desc(c) for c in order])
    return found.withColumn("position", F.row_number().over(by)).filter(F.col("position") <= n)
