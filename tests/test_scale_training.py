"""Training beyond the driver, additive statistics, and several models in one pass."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import linear, naive_bayes, tfidf
from textloom.operators.fused import FusedClassifiers
from textloom.operators.term_partitioned import (
    LOGISTIC_LOSS,
    SQUARED_HINGE,
    TermPartitionedSet,
    combination,
    fit_term_partitioned,
    loss_gradient,
)
from textloom.operators.term_statistics import TermStatistics, counted
from textloom.operators.tfidf import TfidfConfig


@pytest.fixture(scope="module")
def parts(headlines):
    data = TermPartitionedSet(headlines, buckets=3, salts=2)
    yield data
    data.close()


def dense(data: TermPartitionedSet):
    """Features, classes, terms of the stored set."""
    y = {r["_doc"]: r.y for r in data.documents.collect()}
    terms = sorted(r.term for r in data.tfidf.vocabulary.collect())
    X = np.zeros((len(y), len(terms)))
    at = {d: i for i, d in enumerate(sorted(y))}
    for r in data.by_document.collect():
        X[at[r["_doc"]], terms.index(r.term)] = r.x
    return X, np.array([y[d] for d in sorted(y)]), terms


def weights_of(model, terms) -> np.ndarray:
    found = {r.term: r.weights for r in model.terms.collect()}
    return np.array([found[t] for t in terms]).T


@pytest.mark.parametrize("balanced", [False, True])
def test_logistic_optimum(parts, headlines, balanced):
    model = fit_term_partitioned(parts, "tables", LOGISTIC_LOSS, balanced)
    X, y, terms = dense(parts)
    W, b = weights_of(model, terms), np.array(model.intercepts)
    factors = np.array(parts.balanced() if balanced else [1.0] * 4)[y]
    z = X @ W.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p *= factors[:, None]
    gradient = W + p.T @ X
    assert np.sqrt((gradient**2).sum() + (p.sum(0) ** 2).sum()) < 1e-4
    theirs = linear.fit_logistic(linear.TrainingSet(headlines), balanced)
    assert theirs.labels == model.labels
    assert np.abs(W - weights_of(theirs, terms)).max() < 1e-4 * 5


@pytest.mark.parametrize("balanced", [False, True])
def test_squared_hinge_optimum(parts, balanced):
    model = fit_term_partitioned(parts, "tables", SQUARED_HINGE, balanced)
    X, y, terms = dense(parts)
    W, b = weights_of(model, terms), np.array(model.intercepts)
    sides = np.where(np.arange(4)[None, :] == y[:, None], 1.0, -1.0)
    factors = np.where(sides > 0, np.array(parts.balanced() if balanced else [1.0] * 4)[None, :], 1.0)
    slopes = -2 * factors * sides * np.maximum(0, 1 - sides * (X @ W.T + b))
    assert np.sqrt(((W + slopes.T @ X) ** 2).sum() + ((b + slopes.sum(0)) ** 2).sum()) < 1e-4
    assert not model.has_probability and ((X @ W.T + b).argmax(1) == y).all()


def test_no_vector_reaches_the_driver(headlines, monkeypatch):
    """A limit of three coefficients: fits go through the tables, and nothing of the vocabulary's size is collected."""
    from pyspark.sql.classic.dataframe import DataFrame

    def tables():
        return {t.name for t in headlines.sparkSession.catalog.listTables()}

    before = tables()
    monkeypatch.setattr(linear, "MAX_COEFFICIENTS", 3)
    data = linear.TrainingSet(headlines)
    assert not data.on_driver and not hasattr(data, "vectors")
    collected, own = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(rows := own(self)) or rows)
    model = linear.fit_logistic(data, balanced=True)
    svm = linear.fit_svm(data)
    monkeypatch.undo()
    assert max(len(rows) for rows in collected) <= 18 * 18
    assert not any(isinstance(x, list) for rows in collected for r in rows for x in r)
    assert model.name == linear.LOGISTIC_BALANCED and svm.name == linear.SVM
    assert model.predict(headlines, ["Label"]).filter("Label = predicted_label").count() == 13
    assert tables() == before


def test_repeated_and_missing_ids(headlines, parts):
    """Documents are told apart by their number, not by their id."""
    awkward = TermPartitionedSet(headlines.withColumn("ID", F.when(F.col("ID") > 4, F.lit(1))), buckets=2, salts=3)
    try:
        a, b = (fit_term_partitioned(d, "tables", max_iter=3) for d in (parts, awkward))
        terms = dense(parts)[2]
        assert np.allclose(weights_of(a, terms), weights_of(b, terms), atol=1e-9)
    finally:
        awkward.close()


def test_gradient_at_given_weights(parts):
    X, y, terms = dense(parts)
    rng = np.random.default_rng(5)
    W, b = rng.normal(size=(4, len(terms))), rng.normal(size=4)
    spark = parts.spark
    table = spark.createDataFrame([(t, W[:, i].tolist()) for i, t in enumerate(terms)], "term string, weights array<double>")
    got = {r.term: r.gradient for r in loss_gradient(parts, table, b.tolist(), LOGISTIC_LOSS, [1.0, 2.0, 3.0, 4.0]).collect()}
    z = X @ W.T + b
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    want = (p * np.array([1.0, 2, 3, 4])[y][:, None]).T @ X
    assert np.allclose(np.array([got[t] for t in terms]).T, want, atol=1e-12)


def test_directions_from_inner_products():
    """The same direction as the two loops over whole vectors; an unfilled place changes nothing."""
    rng = np.random.default_rng(1)
    m, n = 4, 30
    A = rng.normal(size=(n, n))
    A = A @ A.T + np.eye(n)
    steps = [np.zeros(n), *rng.normal(size=(m - 1, n))]
    differences = [A @ s for s in steps]
    g, w = rng.normal(size=n), rng.normal(size=n)
    q, alphas = g.copy(), {}
    for i in reversed(range(1, m)):
        alphas[i] = steps[i] @ q / (steps[i] @ differences[i])
        q -= alphas[i] * differences[i]
    q *= steps[-1] @ differences[-1] / (differences[-1] @ differences[-1])
    for i in range(1, m):
        q += (alphas[i] - differences[i] @ q / (steps[i] @ differences[i])) * steps[i]
    basis = np.array([*steps, *differences, g, w])
    assert np.allclose(combination(basis @ basis.T, m) @ basis, -q)


# Statistics --------------------------------------------------------------


def as_dict(statistics: TermStatistics):
    return {r.term: (r.df, r.tf) for r in statistics.table.collect()}, statistics.n_docs


def test_parts_add_up(spark, headlines, tmp_path):
    whole = TermStatistics.of(headlines)
    a, b = (TermStatistics.of(headlines.filter(F.col("ID") % 2 == k)) for k in (0, 1))
    empty = TermStatistics.of(headlines.limit(0))
    assert as_dict(a.merge(b)) == as_dict(b.merge(a)) == as_dict(whole) and whole.n_docs == 13
    assert as_dict(whole.subtract(b)) == as_dict(a)
    assert as_dict(a.merge(empty)) == as_dict(a) and as_dict(whole.subtract(whole)) == as_dict(empty) == ({}, 0)
    a.save(str(tmp_path / "a"))
    assert as_dict(TermStatistics.load(spark, str(tmp_path / "a")).merge(b)) == as_dict(whole)
    for bounds in (TfidfConfig(), TfidfConfig(min_df=0.2, max_df=0.5), TfidfConfig(max_features=5)):
        mine, theirs = whole.fit(bounds), tfidf.fit_tfidf(headlines, bounds)
        rows = [{r.term: (r.df, r.tf, r.idf) for r in m.vocabulary.collect()} for m in (mine, theirs)]
        assert rows[0] == rows[1] and (mine.n_docs, mine.n_terms) == (theirs.n_docs, theirs.n_terms)


def test_parts_that_do_not_add_up(headlines):
    a, b = (TermStatistics.of(headlines.filter(F.col("ID") % 2 == k)) for k in (0, 1))
    with pytest.raises(ValueError, match="grams"):
        a.merge(TermStatistics.of(headlines, TfidfConfig(ngram_range=(1, 1))))
    with pytest.raises(ValueError, match="cannot make"):
        a.fit(TfidfConfig(ngram_range=(1, 3)))
    with pytest.raises(ValueError, match="more documents"):
        a.subtract(TermStatistics.of(headlines))
    with pytest.raises(Exception, match="never counted"):
        b.subtract(a)


def test_counted_documents_stand_for_texts(headlines):
    rows = counted(headlines, keep=["Label"])
    assert "Cleaned_Text" not in rows.columns
    model = tfidf.fit_tfidf(headlines)
    a, b = ({(r.ID, r.term): r.tfidf for r in model.transform(d).collect()} for d in (headlines, rows))
    assert a == pytest.approx(b)
    bayes = [naive_bayes.fit_naive_bayes(d) for d in (headlines, rows)]
    p, q = ({r.ID: r for r in m.explain(d).collect()} for m, d in zip(bayes, (headlines, rows), strict=True))
    assert all(p[i].margins == pytest.approx(q[i].margins) and p[i].all_present_features == q[i].all_present_features for i in p)


# Several models ----------------------------------------------------------


def test_fused_equals_single(headlines):
    vocabulary = tfidf.fit_tfidf(headlines)
    models = [naive_bayes.fit_naive_bayes(headlines, alpha=a, tfidf=vocabulary) for a in (1.0, 0.01)]
    models.append(linear.fit_svm(linear.TrainingSet(headlines, tfidf=vocabulary)))
    unknown = headlines.selectExpr("ID + 100 AS ID", "'zzz' AS Cleaned_Text", "Label").limit(1)
    rows = headlines.select("ID", "Cleaned_Text", "Label").unionByName(unknown)
    for model, mine in zip(models, FusedClassifiers(models).predict(rows, ["Label"]), strict=True):
        theirs = model.predict(rows, ["Label"])
        assert mine.columns == theirs.columns
        a, b = ({r.ID: r for r in d.collect()} for d in (mine, theirs))
        assert len(a) == 14 and a.keys() == b.keys()
        for i in a:
            assert a[i].margins == pytest.approx(b[i].margins) and a[i].predicted_label == b[i].predicted_label
            assert [e.label for e in a[i].ranking] == [e.label for e in b[i].ranking]
            assert a[i].features_present_count == b[i].features_present_count


def test_fused_models_share_their_vocabulary(headlines):
    a, b = (naive_bayes.fit_naive_bayes(headlines, TfidfConfig(min_df=k)) for k in (1, 2))
    with pytest.raises(ValueError, match="do not share"):
        FusedClassifiers([a, b])
