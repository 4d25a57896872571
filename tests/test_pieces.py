"""Documents looked up by pieces: what moves, and that nothing is lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textloom.operators import tfidf


def test_documents_move_once(headlines):
    """Their shuffle serves the question and the answer; before, each had its own, of arrays of pairs."""
    model = tfidf.fit_tfidf(headlines)
    counts = tfidf.stored_counts(headlines, model.config, model.columns, ["Label"])
    known = tfidf.known_documents(counts, model.vocabulary.select("term", "df", "idf"), model.columns, ["Label"])
    assert len(known.collect()) == 13
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("at_once", [1, 3, 1_000])
def test_texts_without_terms_and_several_pieces(spark, monkeypatch, at_once):
    texts = ["a b a", None, "", "!!", "c d", "only here", "a b c d ü_1", "a b"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "ID long, Cleaned_Text string, Label string")
    model = tfidf.fit_tfidf(rows)
    table = model.vocabulary.select("term", "df", "idf")

    def found():
        known = tfidf.known_rows(rows, table, model.config, model.columns, ["Label"], outer=True)
        return {(r.ID, r.term, r.tf, r.df, r.idf) for r in known.filter(F.col("idf").isNotNull()).collect()}, {r.ID for r in known.collect()}

    want = found()
    monkeypatch.setattr(tfidf, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(tfidf, "PIECE_TERMS", at_once)
    assert found() == want and want[1] == set(range(8)) and len(want[0]) > 8
