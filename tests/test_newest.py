"""The newest rows of a session, kept by a stream."""

from __future__ import annotations

import random
from collections import defaultdict

import pyarrow as pa
import pytest

from textloom.storage import list_names
from textloom.streaming.newest import _thinned, read_newest, start_newest

SCHEMA = "session string, at long, tie string, what string"


def wanted(rows, n):
    of = defaultdict(list)
    for row in rows:
        of[row[0]].append(row)
    key = lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""))
    return sorted(
        ((*row, i) for rows in of.values() for i, row in enumerate(sorted(rows, key=key, reverse=True)[:n], 1)), key=repr
    )


def play(spark, folder, batches, output, state, n=5, **options):
    """Each batch arrives as one file; the query stops after what is there."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    start_newest(stream, output, state, "session", ["at", "tie"], n, available_now=True, **options).awaitTermination()
    return stream.schema


def kept(spark, output, schema, n=5):
    return sorted(map(tuple, read_newest(spark, output, schema, "session", ["at", "tie"], n).collect()), key=repr)


@pytest.fixture
def log():
    """A hot session, small ones, rows without a session or a time; in no order at all."""
    rng = random.Random(3)
    rows = [("hot", 2**53 + i, f"t{i}", "x") for i in range(300)]
    rows += [(s, i // 2, f"t{i}", s) for s in ("a", "b", "c") for i in range(7)]
    rows += [(None, 1, "u", "no session"), (None, None, "v", None), ("a", None, "w", None), ("once", 5, None, "")]
    rng.shuffle(rows)
    return [rows[i::4] for i in range(4)]


def test_late_rows_restarts_and_folds(spark, log, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "out", "state")]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    seen = []
    for rows in log:  # every batch is a start of its own from the checkpoint
        seen += rows
        schema = play(spark, paths[0], [rows], paths[1], paths[2], fold_every=2)
        assert kept(spark, paths[1], schema) == wanted(seen, 5)
    (run,) = list_names(spark, paths[1])
    assert list_names(spark, f"{paths[1]}/{run}") == ["batch=1", "batch=2", "batch=3"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_a_new_checkpoint_adds_to_the_output(spark, log, tmp_path):
    for name, rows in (("one", log[:2]), ("two", log[2:])):
        schema = play(spark, str(tmp_path / name), rows, str(tmp_path / "out"), str(tmp_path / f"state-{name}"))
    assert kept(spark, str(tmp_path / "out"), schema) == wanted(sum(log, []), 5)


def test_nothing_yet(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert kept(spark, str(tmp_path / "out"), schema) == []


def test_tasks_send_few_rows_of_a_hot_session(log):
    rows = sum(log, [])
    batch = pa.RecordBatch.from_pylist([dict(zip(("session", "at", "tie", "what"), r, strict=True)) for r in rows])
    (thin,) = _thinned(iter([batch]), "session", ["at", "tie"], 5)
    left = [tuple(r.values()) for r in thin.to_pylist()]
    assert len(left) == 5 * 4 + 2 + 1 and wanted(left, 5) == wanted(rows, 5)
