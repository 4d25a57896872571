"""Exact splits for any ids, and intermediate tables that go with their block."""

from __future__ import annotations

import hashlib
import json
import math
import shutil
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textloom.operators import split
from textloom.storage import materialise, new_path, scope, shared_dir
from textloom.streaming.score_stream import parse_payload, start_scoring

SCHEMA = "ID long, Text string, Label string, n long"


def md5(text) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def wanted(rows, seed=42):
    """Rows without their number, with their side, as often as they are there."""
    out = Counter()
    total = len(rows)
    sizes = Counter(r[2] for r in rows)
    draws = math.ceil(total * 0.2)
    base = {k: draws * n // total for k, n in sizes.items()}
    by_rest = sorted(sizes, key=lambda k: (-(draws * sizes[k] % total), k is not None, k or ""))
    for k in by_rest[: draws - sum(base.values())]:
        base[k] += 1
    for label in sizes:
        own = sorted((r for r in rows if r[2] == label), key=lambda r: (md5(f"{seed}:{'' if r[0] is None else r[0]}"), md5(r[1] or "")))
        for i, r in enumerate(own):
            out[(*r[:3], "test" if i < base[label] else "train")] += 1
    return out


CASES = {
    "missing": [(None if i < 30 else i, f"text {i}", "a", i) for i in range(100)],
    "one id": [(7, f"text {i}", "a", i) for i in range(100)],
    "copies": [(7, "same", "a", i) for i in range(100)],
    "copies without id": [(None, None, "ab"[i % 2], i) for i in range(101)],
    "mixed": [(i % 9 if i % 4 else None, f"t{i % 5}", "abc"[i % 3], i) for i in range(211)],
    "no label": [(i, "x", None if i % 3 else "a", i) for i in range(50)],
    "unique": [(i, "x", "ab"[i % 2], i) for i in range(500)],
    "one row": [(None, None, None, 0)],
}


@pytest.mark.parametrize("case", CASES)
def test_split_of_any_ids(spark, case):
    rows = CASES[case]
    got = split.stratified_split(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(r.n for r in got) == sorted(r[3] for r in rows), "every row once"
    assert Counter((r.ID, r.Text, r.Label, r.split) for r in got) == wanted(rows)
    assert sum(r.split == "test" for r in got) == math.ceil(len(rows) * 0.2)


def test_split_reads_texts_only_for_ties(spark):
    unique = split.fit_stratified_split(spark.createDataFrame(CASES["unique"], SCHEMA))
    assert not unique.ties and not unique.partial
    tied = split.fit_stratified_split(spark.createDataFrame(CASES["one id"], SCHEMA))
    assert tied.ties and not tied.partial
    assert split.fit_stratified_split(spark.createDataFrame(CASES["copies"], SCHEMA)).partial


def test_empty_split(spark):
    assert split.stratified_split(spark.createDataFrame([], SCHEMA)).collect() == []


def folders(spark) -> set[str]:
    root = Path(shared_dir(spark).removeprefix("file:")) / "textloom"
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_scopes_own_their_tables(spark):
    before = folders(spark)
    with scope(spark) as outer:
        a = materialise(spark.range(5), "a")
        with scope(spark) as inner:
            assert inner.startswith(outer) and new_path(spark, "x").startswith(inner)
            materialise(spark.range(5), "b")
        assert a.count() == 5
        assert len(folders(spark) - before) == 1
    assert folders(spark) == before
    with pytest.raises(RuntimeError), scope(spark):
        materialise(spark.range(5), "c")
        raise RuntimeError
    assert folders(spark) == before
    kept = materialise(spark.range(3), "kept")
    assert kept.count() == 3 and len(folders(spark) - before) == 1


def test_a_block_run_again_clears_what_was_left(spark):
    with scope(spark, "again") as folder:
        spark.range(4).write.parquet(f"{folder}/left")
        shutil.copytree(folder.removeprefix("file:"), folder.removeprefix("file:") + "-saved")
    shutil.copytree(folder.removeprefix("file:") + "-saved", folder.removeprefix("file:"))
    with scope(spark, "again") as folder:
        assert not Path(folder.removeprefix("file:")).exists()


def test_stream_leaves_nothing_behind(spark, headlines, tmp_path):
    """Twenty micro-batches, a restart, and a checkpoint folder used anew."""
    from textloom.operators.naive_bayes import fit_naive_bayes

    model = fit_naive_bayes(headlines)
    source, output, checkpoint = (tmp_path / n for n in ("in", "out", "checkpoint"))
    source.mkdir()

    def arrive(first: int, n: int) -> None:
        for i in range(first, first + n):
            (source / f"{i:03d}.json").write_text(json.dumps({"headline": f"सामना विजय {i}"}))

    def run() -> int:
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(source))
        start_scoring(model, parse_payload(stream).withColumn("ID", F.lit(1)).select("ID", "Text"), str(output), str(checkpoint), available_now=True).awaitTermination()
        return spark.read.parquet(str(output)).count()

    before = folders(spark)
    arrive(0, 20)
    assert run() == 20
    arrive(20, 2)
    assert run() == 22
    assert folders(spark) == before
    shutil.rmtree(checkpoint)
    assert run() == 44, "a new checkpoint adds to the earlier records"
    assert folders(spark) == before
