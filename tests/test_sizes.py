"""Queries and steps on tables as they come at size: in parts, with many terms, in long texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from contract.queries import QUERIES
from textloom.sources import corpus


@pytest.fixture
def turns(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"word{c % 3} common turn{t}") for c in range(6) for t in range(2)]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_score_of_a_folder(spark, turns, tmp_path, parts):
    """The table may be a folder of files; before, the stream found none of them."""
    turns.repartition(parts).write.parquet(str(tmp_path / "conversations.parquet"))
    scored = QUERIES["stream_score"](spark, str(tmp_path)).collect()
    assert sorted(r.ID for r in scored) == [c * 1_000_000 + t for c in range(6) for t in range(2)]
    assert all(r.predicted_label for r in scored)


def test_training_in_tables_starts_with_a_short_step(spark):
    """The first step shrinks with the number of documents: at 40,000 none of the lengths tried before made the loss smaller,
    and training stopped at weights of zero."""
    from textloom.operators.term_partitioned import TermPartitionedSet, fit_term_partitioned

    rows = spark.range(40_000).selectExpr(
        "id AS ID", "if(id % 3 = 0, 'a', 'b') AS Label", "concat(if(id % 7 = 0, 'x', if(id % 3 = 0, 'u', 'v')), ' common') AS Cleaned_Text"
    )
    data = TermPartitionedSet(rows, buckets=2)
    try:
        model = fit_term_partitioned(data, "tables", max_iter=4)
    finally:
        data.close()
    by_term = {r.term: r.weights for r in model.terms.collect()}
    assert by_term["u"][0] > 1 > 0 > by_term["v"][0]


def test_scans_are_spread_by_the_text_they_hold(spark, tmp_path, monkeypatch):
    """As many pieces as the text has, however well it was stored and however many cores there are."""
    rows = spark.range(400).select("id", F.repeat(F.lit("x"), 1_000).alias("text"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(corpus, "TASK_TEXT_BYTES", 10_000)
    table = corpus.read_parquet(spark, f"{tmp_path}/t", {"ID": "id", "Text": "text"}, "ID")
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert table.rdd.getNumPartitions() == 40 and sum(sizes) == 400 and max(sizes) < 40
    assert corpus.spread(table, "ID").rdd.getNumPartitions() == 40


def test_a_training_pass_stores_few_numbers_of_a_document(spark, headlines, monkeypatch):
    """Five vectors in place of eighteen, in as many tasks as cores however many partitions a shuffle has."""
    from textloom.operators.term_partitioned import SQUARED_HINGE, TermPartitionedSet, fit_term_partitioned

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    data, stored, own = TermPartitionedSet(headlines), [], TermPartitionedSet.bucketed

    def seen(self, rows, keys, **options):
        name, path = own(self, rows, keys, **options)
        if "u" in rows.columns:
            held = spark.table(name).agg(F.sum(F.octet_length("a") + F.octet_length("u")))
            stored.append((held.first()[0], spark.table(name).rdd.getNumPartitions()))
        return name, path

    monkeypatch.setattr(TermPartitionedSet, "bucketed", seen)
    try:
        fit_term_partitioned(data, "tables", SQUARED_HINGE, max_iter=2)
    finally:
        data.close()
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert stored and all(held == 13 * 4 * 8 * 10 for held, _ in stored)
    assert max(tasks for _, tasks in stored) <= max(8, spark.sparkContext.defaultParallelism)


def test_documents_are_sorted_in_pieces_of_their_text(spark, headlines, monkeypatch):
    """As many tasks as the text has pieces; before, merged partitions held more of it the larger the table was."""
    from textloom.operators import tfidf
    from textloom.operators.term_statistics import counted

    model = tfidf.fit_tfidf(headlines)
    want = {(r.ID, r.term): r.tfidf for r in model.transform(headlines).collect()}
    monkeypatch.setattr(tfidf, "DOCUMENT_TEXT_BYTES", 8)
    for rows in (headlines, headlines.drop("Text"), counted(headlines)):
        placed = tfidf.by_document(rows, model.columns)
        assert placed.rdd.getNumPartitions() > max(13, spark.sparkContext.defaultParallelism) and placed.count() == 13
        assert {(r.ID, r.term): r.tfidf for r in model.transform(rows).collect()} == pytest.approx(want)


@pytest.mark.parametrize("ngram_range", [(1, 2), (2, 4), (1, 1)])
def test_statistics_count_a_term_once_a_batch(spark, monkeypatch, ngram_range):
    """What is grouped is a row per term and batch, with the counts that documents have one by one."""
    import pyarrow as pa

    from textloom.operators import tfidf
    from textloom.operators.term_statistics import TermStatistics, counted

    texts = ["a b a b", "b a", "", None, "c", "!!", "a b c d a b", "ü_1 a b", *["a b"] * 50]
    rows = spark.createDataFrame(list(enumerate(texts)), "ID long, Cleaned_Text string").repartition(3)
    config = tfidf.TfidfConfig(ngram_range=ngram_range, min_df=1)
    want = {tuple(r) for r in TermStatistics.of(counted(rows, config), config).table.collect()}
    found = TermStatistics.of(rows, config)
    assert {tuple(r) for r in found.table.collect()} == want and found.n_docs == len(texts)
    monkeypatch.setattr(tfidf, "BATCH_WORDS", 100)
    batches = [pa.record_batch([pa.array(part, pa.string())], ["words"]) for part in (["a b"] * 40, ["a b"] * 40, [None], ["d"])]
    out = [r for b in tfidf._batch_statistics(1, 2)(iter(batches)) for r in b.to_pylist() if r["term"]]
    assert sorted((r["term"], r["df"], r["tf"]) for r in out) == [("a", 80, 80), ("a b", 80, 80), ("b", 80, 80), ("d", 1, 1)]
