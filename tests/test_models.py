from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions.text import TOKEN_PATTERN
from textloom.operators import classifier, linear, metrics, naive_bayes, tfidf
from textloom.plans import evaluation, training
from textloom.sources import artifacts

TOKEN = re.compile(r"[ऀ-ॿ\w]+")


def terms_of(text: str, low: int, high: int) -> Counter:
    w = TOKEN.findall(text)
    return Counter(" ".join(w[i : i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1))


def brute_tfidf(train: dict[int, str], texts: dict[int, str], config: tfidf.TfidfConfig):
    """The definition, term by term."""
    counted = {i: terms_of(t, *config.ngram_range) for i, t in train.items()}
    n = len(counted)
    df, total = Counter(), Counter()
    for c in counted.values():
        df.update(c.keys())
        total.update(c)
    low = config.min_df * n if isinstance(config.min_df, float) else config.min_df
    high = config.max_df * n if isinstance(config.max_df, float) else config.max_df
    vocab = [t for t in df if low <= df[t] <= high]
    if config.max_features is not None:
        vocab = sorted(vocab, key=lambda t: (-total[t], t))[: config.max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 if config.use_idf else 1.0 for t in sorted(vocab)}
    out = {}
    for i, t in texts.items():
        raw = {x: ((1 + math.log(k)) if config.sublinear_tf else k) * idf[x] for x, k in terms_of(t, *config.ngram_range).items() if x in idf}
        length = math.sqrt(sum(v * v for v in raw.values()))
        out[i] = {x: v / length for x, v in raw.items()}
    return idf, out


CONFIGS = [
    tfidf.TfidfConfig(),
    tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, sublinear_tf=False, use_idf=False),
    tfidf.TfidfConfig(ngram_range=(1, 3), min_df=0.1, max_df=0.5),
    tfidf.TfidfConfig(min_df=1, max_df=3, max_features=7),
]


def texts(df) -> dict[int, str]:
    return {r.ID: r.Cleaned_Text for r in df.collect()}


def close(a: dict, b: dict) -> bool:
    return a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)


@pytest.mark.parametrize("config", CONFIGS)
@pytest.mark.parametrize("broadcast", [True, False])
def test_tfidf_is_the_definition(headlines, monkeypatch, config, broadcast):
    if not broadcast:
        monkeypatch.setattr(tfidf, "MAX_BROADCAST_BYTES", 0)
    train, test = headlines.filter("ID % 4 > 0"), headlines.filter("ID % 4 = 0")
    model, on_train, on_test = tfidf.fit_transform_split(train, test, config)
    for side, got_df in ((train, on_train), (test, on_test)):
        idf, want = brute_tfidf(texts(train), texts(side), config)
        got = defaultdict(dict)
        for r in got_df.collect():
            got[r.ID][r.term] = r.tfidf
        assert {i: v for i, v in want.items() if v}.keys() == got.keys()
        assert all(close(got[i], want[i]) for i in got)
    assert close({r.term: r.idf for r in model.vocabulary.collect()}, idf)
    assert model.n_terms == len(idf) and model.n_docs == train.count()
    index = {r.term: r.idx for r in model.indexed_vocabulary().collect()}
    assert index == {t: i for i, t in enumerate(sorted(idf))}


def test_hot_terms_take_the_other_way(headlines):
    rows = tfidf.term_rows(headlines, tfidf.TfidfConfig(), tfidf.DEFAULT_COLUMNS, outer=True)
    model = tfidf.fit_tfidf(headlines)
    table = model.vocabulary.select("term", "df", "idf")
    plain = tfidf.lookup_terms(rows, table, True)
    key = lambda r: tuple(map(str, r))
    for salts in (1, 3, 16):
        skewed = tfidf.lookup_terms(rows, table, True, max_bytes=0, salts=salts)
        columns = ["ID", "term", "tf", "df", "idf"]
        assert sorted(skewed.select(columns).collect(), key=key) == sorted(plain.select(columns).collect(), key=key)


@pytest.mark.parametrize("ids", ["ID", "if(ID < 6, 1, if(ID = 7, null, ID))"])
def test_large_tables_are_looked_up_by_pieces(headlines, monkeypatch, ids):
    """Same features with ids that repeat or are missing, out of pieces that ask for a term once; nothing is copied by salt."""
    model = tfidf.fit_tfidf(headlines)
    rows = headlines.withColumn("ID", F.expr(ids))
    key = lambda r: (str(r.ID), r.term, r.tf, r.df, r.Label, round(r.tfidf, 12))
    want = sorted(key(r) for r in model.transform(rows, ["Label"]).collect())
    monkeypatch.setattr(tfidf, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(tfidf, "PIECE_TERMS", 5)
    got = model.transform(rows, ["Label"])
    assert sorted(key(r) for r in got.collect()) == want
    plan = got._jdf.queryExecution().toString()
    assert "_salt" not in plan and "FlatMapCoGroupsInArrow" in plan


def test_terms_keep_numbers_and_mixed_script(headlines):
    terms = {r.term for r in tfidf.fit_tfidf(headlines, tfidf.TfidfConfig(min_df=1)).vocabulary.collect()}
    assert {"5g", "10", "5g स्मार्टफोन", "मुख्यमंत्री"} <= terms


def test_configuration():
    with pytest.raises(ValueError):
        tfidf.TfidfConfig(ngram_range=(2, 1))
    assert tfidf.TfidfConfig().as_dict()["min_df"] == 2


def test_sparsity(spark):
    two_cells = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, term string")
    assert abs(tfidf.sparsity(two_cells, 2, 3).first().sparsity_pct - 200 / 3) < 1e-9
    assert tfidf.sparsity(two_cells.limit(0), 0, 3).first().sparsity_pct == 0.0


def test_vectors(headlines):
    data = linear.TrainingSet(headlines)
    idf, want = brute_tfidf(texts(headlines), texts(headlines), tfidf.TfidfConfig())
    order = sorted(idf)
    rows = data.vectors.collect()
    assert len(rows) == 13
    for r in rows:
        assert r.features.size == len(order) and list(r.features.indices) == sorted(r.features.indices)
        got = {order[j]: v for j, v in zip(r.features.indices, r.features.values)}
        assert close(got, want[r.ID])


def brute_bayes(train, labels: dict[int, str], side):
    idf, feats = brute_tfidf(texts(train), texts(train), tfidf.TfidfConfig())
    classes = sorted(set(labels.values()))
    sums = {c: defaultdict(float) for c in classes}
    for i, v in feats.items():
        for t, x in v.items():
            sums[labels[i]][t] += x
    theta = {c: {t: math.log((sums[c][t] + 1) / (sum(sums[c].values()) + len(idf))) for t in idf} for c in classes}
    prior = {c: math.log(sum(v == c for v in labels.values()) / len(labels)) for c in classes}
    _, rows = brute_tfidf(texts(train), texts(side), tfidf.TfidfConfig())
    joint = {i: {c: prior[c] + sum(x * theta[c][t] for t, x in v.items()) for c in classes} for i, v in rows.items()}
    return {i: {c: math.exp(z[c]) / sum(map(math.exp, z.values())) for c in classes} for i, z in joint.items()}


@pytest.fixture(scope="module")
def bayes(headlines):
    return naive_bayes.fit_naive_bayes(headlines)


def test_naive_bayes_is_the_definition(spark, headlines, bayes):
    labels = {r.ID: r.Label for r in headlines.collect()}
    unseen = spark.createDataFrame([(90, "!!!"), (91, "अज्ञात शब्द"), (92, "विजय बैठक विजय")], "ID long, Cleaned_Text string")
    side = headlines.select("ID", "Cleaned_Text").unionByName(unseen)
    want = brute_bayes(headlines, labels, side)
    got = {r.ID: r for r in bayes.predict(side).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert close({e.label: e.probability for e in r.ranking}, want[i])
        order = sorted(want[i], key=lambda c: (-want[i][c], c))
        assert [e.label for e in r.ranking] == order and r.predicted_label == order[0]
    # No known term: the prior decides, ties go to the first label.
    assert got[90].features_present_count == 0 and got[90].predicted_label == "Politics"
    assert math.isclose(got[91].predicted_probability, 4 / 13)


def test_scores_do_not_depend_on_the_join(headlines, bayes, monkeypatch):
    want = {r.ID: r.margins for r in bayes.predict(headlines).collect()}
    monkeypatch.setattr(tfidf, "MAX_BROADCAST_BYTES", 0)
    got = {r.ID: r.margins for r in bayes.predict(headlines).collect()}
    assert all(np.allclose(got[i], want[i], rtol=1e-12) for i in want)


@pytest.fixture(scope="module")
def training_set(headlines):
    return linear.TrainingSet(headlines)


@pytest.mark.parametrize("balanced", [False, True])
def test_logistic_regression_is_optimal(training_set, balanced):
    """The gradient of 0.5 |W|^2 + C sum(weight * loss) vanishes at the fitted weights."""
    model = linear.fit_logistic(training_set, balanced)
    rows = training_set.vectors.collect()
    order = {r.term: r.idx for r in training_set.vocabulary.collect()}
    W = np.zeros((len(model.labels), len(order)))
    for r in model.terms.collect():
        W[:, order[r.term]] = r.weights
    X = np.array([r.features.toArray() for r in rows])
    y = np.array([model.labels.index(r.Label) for r in rows])
    weight = np.array([training_set.balanced()[r.Label] if balanced else 1.0 for r in rows])
    z = X @ W.T + np.array(model.intercepts)
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    grad = W + (p * weight[:, None]).T @ X
    assert np.abs(grad).max() < 5e-3 * len(rows) ** 0.5
    assert np.abs((p * weight[:, None]).sum(0)).max() < 5e-2


def test_balanced_weights(headlines, training_set):
    n = Counter(r.Label for r in headlines.collect())
    want = {c: 13 / (4 * k) for c, k in n.items()}
    assert training_set.balanced() == pytest.approx(want)
    assert {r.label: r.weight for r in classifier.class_weights(headlines).collect()} == pytest.approx(want)


def test_label_index(headlines):
    rows = classifier.with_label_index(headlines, ["Sports", "Politics", "Business"]).collect()
    assert {(r.Label, r.label_index) for r in rows} == {("Business", 0), ("Politics", 1), ("Sports", 2), ("Tech", None)}


def test_svm_has_no_probabilities_and_separates(headlines, training_set):
    for balanced in (False, True):
        model = linear.fit_svm(training_set, balanced)
        rows = model.predict(headlines, ["Label"]).collect()
        assert not model.has_probability
        assert all(r.predicted_probability is None and r.ranking[0].probability is None for r in rows)
        assert sum(r.Label == r.predicted_label for r in rows) >= 12
        for r in rows:
            assert r.predicted_label == model.labels[int(np.argmax(r.margins))]


def test_comparison_and_selection(headlines):
    fitted, results = training.compare(training.candidates(headlines), headlines)
    rows = {r.Model: r for r in results.collect()}
    assert set(rows) == set(fitted) and len(rows) == 5
    for r in rows.values():
        for m in ("Accuracy", "Macro_F1", "Weighted_F1", "Macro_Precision", "Weighted_Recall"):
            assert 0 <= r[m] <= 1
        assert r.Supports_Proba == ("SVM" not in r.Model) and r.Training_Time > 0 and r.Prediction_Time > 0
    best = training.select_model(results).first()
    assert best.Macro_F1 == max(r.Macro_F1 for r in rows.values() if r.Supports_Proba)


def test_production_artifacts(spark, headlines, tmp_path):
    rows = headlines.withColumn("split", F.when(F.col("ID").isin(1, 5, 9), "test").otherwise("train"))
    training.train_production(rows, str(tmp_path))
    meta = artifacts.read_metadata(spark, str(tmp_path)).first()
    assert meta.training_documents == 13 and meta.classes == ["Business", "Politics", "Sports", "Tech"]
    held_out = linear.fit_logistic(linear.TrainingSet(rows.filter("split = 'train'")), balanced=True)
    wanted = held_out.predict(rows.filter("split = 'test'"), ["Label"])
    right = wanted.filter("Label = predicted_label").count()
    assert meta.evaluation["Accuracy"] == pytest.approx(right / 3)
    assert set(meta.per_class_f1) == set(meta.per_class_recall) == set(meta.classes)
    assert meta.test_documents == 3 and meta.token_pattern == TOKEN_PATTERN
    assert meta.hyperparameters["class_weight"] == "balanced" and meta.hyperparameters["C"] == "1.0"
    assert sum(meta.per_class_recall.values()) == pytest.approx(right)  # one test document in three of the classes


def test_artifacts_roundtrip(spark, headlines, bayes, tmp_path):
    artifacts.save_classifier(bayes, str(tmp_path), artifacts.Measured({"Accuracy": 0.9}, {"Sports": 1.0}))
    loaded = artifacts.load_classifier(spark, str(tmp_path))
    assert (loaded.labels, loaded.intercepts, loaded.config) == (bayes.labels, bayes.intercepts, bayes.config)
    a = {r.ID: r.margins for r in bayes.predict(headlines).collect()}
    b = {r.ID: r.margins for r in loaded.predict(headlines).collect()}
    assert all(np.allclose(a[i], b[i], rtol=1e-12) for i in a)
    meta = artifacts.read_metadata(spark, str(tmp_path)).first()
    assert meta.evaluation == {"Accuracy": 0.9} and meta.vocabulary_size == bayes.n_terms
    assert artifacts.coefficients(loaded).count() == 4 * bayes.n_terms
    for missing in ("", "/terms"):
        with pytest.raises(Exception):
            artifacts.load_classifier(spark, str(tmp_path) + missing + "/none")


def test_versions_are_published_whole(spark, headlines, bayes, tmp_path):
    path = str(tmp_path)
    first = artifacts.save_classifier(bayes, path)
    loaded = artifacts.load_classifier(spark, path)
    # A save that is cut off before its pointer, with or without all parts, is not seen.
    for part in ("versions/half/terms", "versions/other/metadata"):
        bayes.terms.limit(1).write.parquet(f"{path}/{part}")
    assert artifacts.current_version(spark, path) == first
    # A model loaded from a path can be saved there, and the one loaded before still reads its own version.
    second = artifacts.save_classifier(replace(loaded, name="again", hyperparameters={"alpha": "2.0"}), path)
    assert artifacts.load_classifier(spark, path).name == "again"
    assert artifacts.load_classifier(spark, path).hyperparameters == {"alpha": "2.0"}
    assert artifacts.load_classifier(spark, path, first).name == bayes.name
    assert loaded.predict(headlines).count() == headlines.count()
    artifacts.publish(spark, path, first)
    assert artifacts.publications(spark, path) == [first, second, first]
    third = artifacts.save_classifier(bayes, path)
    assert artifacts.drop_versions(spark, path, keep=2) == [second]
    assert artifacts.publications(spark, path) == [first, first, third]
    assert artifacts.load_classifier(spark, path, first).terms.count() == bayes.n_terms
    for version in (second, "never"):
        with pytest.raises(ValueError):
            artifacts.publish(spark, path, version)
    with pytest.raises(ValueError):
        artifacts.load_classifier(spark, path + "/nothing")


# Metrics ----------------------------------------------------------------

PAIRS = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("b", "a")] + [("c", "a")] * 2
LABELS = ["c", "a", "b", "never"]


@pytest.fixture(scope="module")
def counts(spark):
    df = spark.createDataFrame([(i, a, p) for i, (a, p) in enumerate(PAIRS)], "ID long, Label string, predicted_label string")
    return metrics.confusion_counts(df)


def brute_metrics():
    out = {}
    for c in LABELS:
        tp = sum(a == p == c for a, p in PAIRS)
        called, support = sum(p == c for _, p in PAIRS), sum(a == c for a, _ in PAIRS)
        precision, recall = tp / called if called else 0.0, tp / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        out[c] = (precision, recall, f1, support)
    return out


def test_class_report(counts):
    rows = metrics.class_report(counts, LABELS).orderBy("position").collect()
    assert [r.label for r in rows] == LABELS
    want = brute_metrics()
    for r in rows:
        assert (r.precision, r.recall, r.f1, r.support) == pytest.approx(want[r.label])


def test_overall_metrics(counts):
    want, r = brute_metrics(), metrics.overall_metrics(counts, LABELS).first()
    n = len(PAIRS)
    assert r.Accuracy == pytest.approx(8 / n)
    for k, name in enumerate(("Precision", "Recall", "F1")):
        assert r[f"Macro_{name}"] == pytest.approx(sum(v[k] for v in want.values()) / 4)
        assert r[f"Weighted_{name}"] == pytest.approx(sum(v[k] * v[3] for v in want.values()) / n)
    gate = {g.metric: g.passed for g in metrics.metric_gate(metrics.overall_metrics(counts, LABELS), {"Accuracy": 8 / n, "Macro_F1": 0.0}).collect()}
    assert gate == {"Accuracy": True, "Macro_F1": False}


def test_confusion(counts):
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(counts, LABELS).collect()}
    assert len(cells) == 16 and sum(cells.values()) == len(PAIRS) and cells["a", "b"] == 2 and cells["never", "a"] == 0
    wide = metrics.wide_confusion_matrix(counts, LABELS)
    assert wide.columns == ["actual", *LABELS] and [r.actual for r in wide.collect()] == LABELS
    share = {(r.actual, r.predicted): r.share for r in metrics.normalised_confusion(counts, LABELS).collect()}
    assert share["a", "b"] == pytest.approx(2 / 7) and share["never", "a"] is None


def test_error_pairs(counts):
    got = [tuple(r) for r in metrics.error_pairs(counts, top=2).collect()]
    assert got == [("a", "b", 2, 28.57), ("c", "a", 2, 100.0)]
    assert metrics.error_pairs(counts).count() == 3


def test_strata_without_errors(spark):
    df = spark.createDataFrame([(1, "a", "a", 0.9)], "ID long, Label string, predicted_label string, predicted_probability double")
    assert all(r.n == 0 and r.pct is None for r in metrics.confidence_strata(df).collect())
    wrong = spark.createDataFrame([(1, "a", "b", p) for p in (0.69996, 0.69, 0.4, 0.39994)], df.schema)
    assert {r.stratum: (r.n, r.pct) for r in metrics.confidence_strata(wrong).collect()} == {"high": (1, 25.0), "medium": (2, 50.0), "low": (1, 25.0)}


def test_full_evaluation(headlines, bayes, tmp_path):
    train = headlines.filter("ID <> 1 and ID <> 9")
    model = naive_bayes.fit_naive_bayes(train)
    reports = evaluation.evaluate(model, headlines, ["Tech", "Sports", "Politics", "Business"], {"Accuracy": 1.0}, top_n=3)
    errors = reports["errors"].collect()
    predicted = reports["predictions"].collect()
    assert {r.ID for r in errors} == {r.ID for r in predicted if r.Label != r.predicted_label}
    for r in errors:
        assert r.Top_1_Class == r.Predicted_Label != r.Actual_Label
        assert r.Top_1_Probability == r.Prediction_Confidence >= r.Top_2_Probability >= r.Top_3_Probability
    top = reports["top_features"].collect()
    assert Counter(r.Class for r in top) == dict.fromkeys(model.labels, 3)
    for c in model.labels:
        ranked = [r.Coefficient for r in sorted((r for r in top if r.Class == c), key=lambda r: r.Rank)]
        assert ranked == sorted(ranked, reverse=True)
    evaluation.write_reports(reports, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == {"metrics", "class_report", "errors", "error_pairs", "top_features"}


def test_two_classes_leave_the_third_rank_empty(headlines):
    two = headlines.filter("Label in ('Sports', 'Politics')")
    model = naive_bayes.fit_naive_bayes(two)
    wrong = model.predict(two.withColumn("Label", F.lit("Other")), ["Label"])
    rows = metrics.error_analysis(wrong, two).collect()
    assert len(rows) == 8 and all(r.Top_3_Class is None and r.Top_3_Probability is None for r in rows)
