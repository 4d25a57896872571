from __future__ import annotations

import glob
import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textloom import sizing
from textloom.columns import Columns
from textloom.operators import audit, prepare, split, stats
from textloom.plans import preparation
from textloom.sources import corpus


def test_csv_with_mark_and_quoted_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('ID,Text,Label,Original_Label\n1,"line\nbreak ""quoted"", comma",A,a\n2,शीर्षक,B,b\n', encoding="utf-8-sig")
    rows = corpus.read_csv(spark, str(path)).orderBy("ID").collect()
    assert [tuple(r) for r in rows] == [(1, 'line\nbreak "quoted", comma', "A", "a"), (2, "शीर्षक", "B", "b")]


def test_written_csv_starts_with_the_mark(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc', "L", "l")], corpus.CORPUS_SCHEMA)
    corpus.write_csv(df, str(tmp_path / "out"))
    part = glob.glob(str(tmp_path / "out" / "part-*"))[0]
    assert open(part, "rb").read().startswith(b"\xef\xbb\xbfID,")
    assert corpus.read_csv(spark, str(tmp_path / "out")).collect() == df.collect()


def test_csv_columns_go_by_name_and_bad_rows_are_told(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Text,More,Label,ID,Original_Label\nnews,x,A,7,a\nother,y,B,no number,b\n", encoding="utf-8-sig")
    for multiline in (True, False):
        rows = corpus.read_csv(spark, str(path), multiline=multiline, keep_corrupt=True).cache().collect()
        assert [tuple(r)[:4] for r in rows] == [(7, "news", "A", "a"), (None, "other", "B", "b")]
        assert [r[corpus.CORRUPT] is not None for r in rows] == [False, True]
    (tmp_path / "less.csv").write_text("ID,Text\n1,a\n")
    with pytest.raises(ValueError, match="Label"):
        corpus.read_csv(spark, str(tmp_path / "less.csv"))


def test_missing_source_fails_early(spark):
    with pytest.raises(AnalysisException):
        corpus.read_csv(spark, "/nonexistent/file.csv").schema
    with pytest.raises(AnalysisException):
        spark.read.parquet("/nonexistent/file.parquet")


@pytest.mark.parametrize("as_csv", [True, False])
def test_split_tables(spark, headlines, tmp_path, as_csv):
    rows = split.stratified_split(headlines)
    corpus.write_splits(rows, str(tmp_path), as_csv=as_csv)
    for side in corpus.SPLITS:
        want = rows.filter(F.col("split") == side).select("ID", "Cleaned_Text", "Label")
        got = corpus.read_split(spark, str(tmp_path), side, as_csv=as_csv)
        assert sorted(got.collect()) == sorted(want.collect())
    if not as_csv:
        check = corpus.verify_splits(rows, str(tmp_path)).collect()
        assert len(check) == 2 and all(r.rows_match and r.columns_match for r in check)


def copies(spark):
    """300 copies of one text among single ones."""
    rows = [(i, "same" if i < 300 else f"text {i}", "ab"[i % 2]) for i in range(500)]
    return spark.createDataFrame(rows, "ID long, Text string, Label string")


def test_duplicates(spark):
    df = copies(spark)
    members = audit.duplicate_members(df, "Text").select("ID", "copies").collect()
    assert sorted(r.ID for r in members) == list(range(300)) and {r.copies for r in members} == {300}
    summary = audit.duplicate_summary(df, "Text").first()
    assert (summary.n_groups, summary.n_rows, summary.n_surplus) == (1, 300, 299)


@pytest.mark.parametrize("as_text", [True, False])
def test_missing_values_are_duplicates_of_each_other(spark, as_text):
    schema = f"ID long, Text {'string' if as_text else 'long'}"
    values = [None, None, "x", "x", "y", ""] if as_text else [None, None, 1, 1, 2, 3]
    df = spark.createDataFrame(list(enumerate(values)), schema)
    members = audit.duplicate_members(df, "Text", as_text=as_text).collect()
    assert sorted((r.ID, r.copies) for r in members) == [(0, 2), (1, 2), (2, 2), (3, 2)]
    assert audit.duplicate_summary(df, "Text", as_text=as_text).first().n_rows == 4


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salts", [1, 3, 50])
def test_skew_safe_lookup_is_a_join(spark, how, salts):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"k{i % 5}") for i in range(60)], "rid int, key string")
    keyed = rows.filter("key is not null and key <> 'k4'").groupBy("key").agg(F.count("*").alias("n"))
    keyed = keyed.withColumn("v", F.upper("key"))
    got = sizing.skew_safe_lookup(rows, keyed, "key", how, salts)
    want = rows.join(keyed, "key", how).select("rid", "key", "n", "v")
    key = lambda r: tuple(map(str, r))
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_an_unknown_key_of_most_rows_is_spread(spark):
    rows = spark.range(8_000).select("id", F.when(F.col("id") % 10 == 0, "known").otherwise("unknown").alias("key"))
    keyed = spark.createDataFrame([("known", 1)], "key string, v int").hint("shuffle_hash")
    joined = sizing.skew_safe_lookup(rows.repartition(3), keyed, "key", "left", salts=64)
    assert joined.filter("v = 1").count() == 800 and joined.count() == 8_000
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64("id", "key"), F.lit(64))).repartition(40, "key", "_salt")
    assert max(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()) < 8_000 / 8


def test_quota_of_huge_counts(spark):
    counts = {"a": 7 * 10**12 + 3, "b": 10**12 + 1, "c": 5}
    got = {r.label: r.n_test for r in split.quota(spark.createDataFrame(list(counts.items()), "label string, n long"), 0.2).collect()}
    total = sum(counts.values())
    draws = -(-total // 5)
    base = {x: draws * n // total for x, n in counts.items()}
    order = sorted(counts, key=lambda x: (-(draws * counts[x] % total), x))
    for x in order[: draws - sum(base.values())]:
        base[x] += 1
    assert got == base


def test_bounds_are_enforced(spark):
    ten = spark.range(10)
    assert sizing.bounded(ten, 10, "rows").count() == 10
    with pytest.raises(Exception, match="too many rows"):
        sizing.bounded(ten, 9, "rows").collect()
    with pytest.raises(ValueError, match="too many rows"):
        sizing.bounded_collect(ten, 9, "rows")


def test_conflicts_and_overlap(spark):
    df = spark.createDataFrame(
        [(1, "x", "A", "train"), (2, "x", "B", "test"), (3, "y", "A", "train"), (4, "y", "A", "train"), (5, "z", "B", "test")],
        "ID long, Cleaned_Text string, Label string, split string",
    )
    conflict = audit.label_conflicts(df).collect()
    assert [(r.text_digest, r.n_labels, r.n_rows) for r in conflict] == [(hashlib.sha256(b"x").hexdigest(), 2, 2)]
    assert tuple(audit.split_overlap(df).first()) == (2, 2, 1)


def test_integrity_report(spark):
    df = spark.createDataFrame(
        [(1, "a", "A", "a"), (1, "b", "B", "b"), (2, "a", "B", "a")], "ID long, Text string, Label string, Cleaned_Text string"
    )
    report = {r.check: (r.value, r.passed) for r in audit.integrity_report(df, ["A", "C"]).collect()}
    assert report["null_values"] == (0, True)
    assert report["labels_off_domain"] == (2, False)
    assert report["duplicate_ID"] == (2, False)
    assert report["duplicate_Text"] == (2, True)
    assert report["conflicting_labels"] == (1, False)


def test_null_counts_and_row_check(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert {r.column_name: r.n_null for r in audit.null_counts(df).collect()} == {"a": 1, "b": 2}
    assert audit.row_count_check(df, 3).first().passed and not audit.row_count_check(df, 4).first().passed
    assert audit.row_count_check(df).first().passed


PUBLISHED = {"Technology & Science": (6301, 1260), "Politics": (4029, 806), "Sports": (1679, 336), "Entertainment": (1418, 284), "Business": (696, 139)}


def test_published_split_sizes(spark):
    labels = [(i, label) for i, label in enumerate(x for x, (n, _) in PUBLISHED.items() for _ in range(n))]
    df = spark.createDataFrame(labels, "ID long, Label string")
    quota = {r.label: r.n_test for r in split.split_quota(df).collect()}
    assert quota == {x: t for x, (_, t) in PUBLISHED.items()}
    rows = split.stratified_split(df)
    counted = Counter((r.Label, r.split) for r in rows.collect())
    assert {x: counted[x, "test"] for x in PUBLISHED} == quota
    assert sum(counted.values()) == 14123
    dist = audit.split_distribution(rows).collect()
    assert all(abs(r.train_pct - r.test_pct) < 0.5 for r in dist)


@pytest.mark.parametrize("test_size,n", [(0.2, 50), (0.5, 7), (0.0, 9), (1.0, 9)])
def test_split_is_the_seeded_order(spark, test_size, n):
    data = [(i, "abc"[i % 3]) for i in range(n)]
    df = spark.createDataFrame(data, "ID long, Label string")
    got = {r.ID for r in split.stratified_split(df, test_size, seed=5).filter("split = 'test'").collect()}
    by_label = defaultdict(list)
    for i, label in data:
        by_label[label].append((hashlib.md5(f"5:{i}".encode()).hexdigest(), i))
    draws = math.ceil(n * test_size)
    base = {x: draws * len(v) // n for x, v in by_label.items()}
    order = sorted(by_label, key=lambda x: (-(draws * len(by_label[x]) % n), x))
    for x in order[: draws - sum(base.values())]:
        base[x] += 1
    assert got == {i for x, v in by_label.items() for _, i in sorted(v)[: base[x]]}


def test_group_split_keeps_copies_together(spark):
    df = prepare.prepare(copies(spark))  # one text has both labels
    rows = split.group_split(df)
    assert rows.count() == 500
    assert audit.split_overlap(rows).first().n_overlap == 0
    assert rows.filter("Text = 'same'").select("split").distinct().count() == 1


def test_statistics(spark, headlines):
    rows = split.stratified_split(headlines)
    record = stats.corpus_statistics_record(rows).first()
    assert record.total_records == 13 and record.total_categories == 4
    assert record.train_records + record.test_records == 13
    assert record.category_counts["Sports"] == 4 and record.category_percentages["Sports"] == 30.77
    profile = {r.label: r for r in stats.category_profile(headlines).collect()}
    assert profile["Business"].record_count == 2 and profile["Business"].avg_words == 4.0


def test_samples_and_categories(spark, headlines):
    samples = stats.category_samples(headlines, n=3).collect()
    assert Counter(r.Label for r in samples) == {"Sports": 3, "Politics": 3, "Tech": 3, "Business": 2}
    assert stats.random_rows(headlines, 1, seed=1, category="SPORTS").first().Label == "Sports"
    assert stats.random_rows(headlines, 1).count() == 1
    assert stats.in_category(headlines, "all").count() == 13
    assert not stats.category_check(headlines, "unknown").first().known


def test_sample_plan_limits_before_the_shuffle(headlines, capsys):
    stats.category_samples(headlines).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_label_domain(spark, headlines):
    got = {r.label: r.status for r in audit.label_domain(headlines, ["Sports", "Politics", "Weather"]).collect()}
    assert got == {"Sports": "ok", "Politics": "ok", "Weather": "missing", "Tech": "unexpected", "Business": "unexpected"}


def test_other_column_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b")], "key long, kind string")
    rows = split.stratified_split(df, 0.5, columns=Columns(id="key", label="kind"))
    assert Counter((r.kind, r.split) for r in rows.collect()) == {("a", "train"): 1, ("a", "test"): 1, ("b", "train"): 1, ("b", "test"): 1}


def test_prepare_corpus(spark, headlines, tmp_path):
    raw = headlines.drop("Cleaned_Text")
    labels = ["Sports", "Politics", "Tech", "Business"]
    reports = preparation.prepare_corpus(raw, str(tmp_path / "a"), labels)
    assert all(r.passed for r in reports["integrity"].collect())
    assert all(r.rows_match and r.columns_match for r in reports["written"].collect())
    assert reports["table"].count() == 13 and reports["overlap"].first().n_overlap == 0
    assert sum(r.total for r in reports["distribution"].collect()) == 13
    doubled = raw.unionByName(raw.withColumn("ID", F.col("ID") + 100))
    assert preparation.prepare_corpus(doubled, str(tmp_path / "b"), labels, by_text=True)["overlap"].first().n_overlap == 0
    with pytest.raises(ValueError, match="labels_off_domain"):
        preparation.prepare_corpus(raw, str(tmp_path / "c"), ["Sports"])
    with pytest.raises(ValueError, match="duplicate_ID"):
        preparation.prepare_corpus(raw.unionByName(raw), str(tmp_path / "d"), labels)
    assert not (tmp_path / "c").exists() and not (tmp_path / "d").exists()
