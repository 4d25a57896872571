"""The range reader for quoted CSV against Spark's reader, which takes a file in one task."""

from __future__ import annotations

import random
from contextlib import contextmanager

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.sources import corpus, quoted_csv


@contextmanager
def ranges_of(spark, size):
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(spark, path, **options):
    return (
        sorted_rows(quoted_csv.read_quoted_csv(spark, str(path), **options)),
        sorted_rows(corpus.read_csv(spark, str(path), **options)),
    )


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def random_file(draw, rows, end="\n"):
    """Values of quotes, commas and line ends, quoted where they must be, and bare values with quotes inside."""
    lines = ["ID,Text,Label,Original_Label"]
    for i in range(rows):
        text = "".join(draw.choice(["a", "é", ",", '"', end, '""', " "]) for _ in range(draw.randint(0, 40)))
        bare = draw.choice(["", "x", 'y"z', '5" pipe', 'a"b"c'])
        lines.append(",".join([str(i), quoted(text), bare, draw.choice(["L", quoted("m" + end), ""])]))
        if draw.random() < 0.1:
            lines.append("")
    return end.join(lines) + draw.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [30, 100_000])
def test_equals_the_reader_of_whole_files(spark, tmp_path, end, size):
    draw = random.Random(f"{size}{end}")
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(random_file(draw, 15, end), encoding="utf-8-sig", newline="")
    with ranges_of(spark, size):
        got, want = both(spark, tmp_path)
    assert got == want and len(got) == 30


def test_a_value_over_many_ranges_and_an_open_quote(spark, tmp_path):
    long = "\n".join(f'line {i}, "said"' for i in range(60))
    body = f'ID,Text,Label,Original_Label\n1,{quoted(long)},A,a\n2,x,B,b\n3,"never closed\nto, the\nend'
    (tmp_path / "in.csv").write_text(body)
    with ranges_of(spark, 64):
        got, want = both(spark, tmp_path / "in.csv")
    assert got == want and len(got) == 3
    assert (1, long, "A", "a") in got


@pytest.mark.parametrize("body", ["", "\n\n", '1,"",,\n', '1,"a\nb",L'])
def test_few_rows(spark, tmp_path, body):
    (tmp_path / "in.csv").write_text("ID,Text,Label,Original_Label\n" + body)
    for size in (5, 1000):
        with ranges_of(spark, size):
            got, want = both(spark, tmp_path / "in.csv")
        assert got == want


def test_header_over_several_ranges(spark, tmp_path):
    wide = '"More\nand, more"'
    (tmp_path / "in.csv").write_text(f"{wide},Text,Label,ID,Original_Label\nx,news,A,7,a\ny,other,B,8,b\n")
    with ranges_of(spark, 4):
        got, want = both(spark, tmp_path / "in.csv")
    assert got == want == [(7, "news", "A", "a"), (8, "other", "B", "b")]


def test_rows_that_do_not_fit_are_told(spark, tmp_path):
    (tmp_path / "in.csv").write_text('ID,Text,Label,Original_Label\n1,"a\nb",A,a\nno number,c,B,b\n2,d\n')
    with ranges_of(spark, 20):
        rows = quoted_csv.read_quoted_csv(spark, str(tmp_path), keep_corrupt=True).collect()
    told = {(r.ID, r.Text): r[corpus.CORRUPT] is not None for r in rows}
    assert told == {(1, "a\nb"): False, (None, "c"): True, (2, "d"): True}
    (tmp_path / "in.csv").write_text("ID,Text\n1,a\n")
    with pytest.raises(ValueError, match="Label"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path))


def test_lines_are_read_by_many_tasks_and_only_crossing_records_move(spark, tmp_path):
    rows = [f'{i},"first {i}\nsecond, ""{i}""",L,l' for i in range(5000)]
    (tmp_path / "in.csv").write_text("ID,Text,Label,Original_Label\n" + "\n".join(rows) + "\n")
    with ranges_of(spark, 8_000):
        assert quoted_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        got = quoted_csv.read_quoted_csv(spark, str(tmp_path))
        assert got.agg(F.count("ID"), F.countDistinct("ID"), F.min("Text")).first()[:2] == (5000, 5000)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_ranges_cut_otherwise_by_the_second_scan_are_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_text("ID,Text,Label,Original_Label\n" + '1,"a\nb",A,a\n' * 50)
    entered = quoted_csv._entered

    def other_ranges(ranges):
        return entered(ranges).withColumn("start", F.col("start") + 1)

    monkeypatch.setattr(quoted_csv, "_entered", other_ranges)
    with ranges_of(spark, 50), pytest.raises(PySparkException, match="cut differently"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path)).collect()
