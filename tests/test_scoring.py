from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from textloom import jobs
from textloom.functions import profile
from textloom.operators import linear, naive_bayes
from textloom.plans import scoring
from textloom.sources import export
from textloom.streaming.recent import recent_predictions
from textloom.streaming.score_stream import parse_payload, start_scoring

TEXTS = [
    (1, "भारताने अंतिम सामन्यात विजय मिळवला"),
    (2, "नवीन 5G स्मार्टफोन भारतात लाँच, किंमत फक्त"),
    (3, "   \t "),
    (4, None),
    (5, "​"),
    (6, "!!!"),
    (7, "मुख्यमंत्री &amp; महत्त्वाची बैठक"),
]


@pytest.fixture(scope="module")
def models(headlines):
    return naive_bayes.fit_naive_bayes(headlines), linear.fit_logistic(linear.TrainingSet(headlines), balanced=True)


@pytest.fixture(scope="module")
def inputs(spark):
    return spark.createDataFrame(TEXTS, "ID long, Text string")


def test_batch_keeps_every_row(models, inputs):
    for model in models:
        rows = {r.ID: r for r in scoring.score_batch(model, inputs, top_k=3).collect()}
        assert len(rows) == len(TEXTS)
        assert {i: r.error for i, r in rows.items()} == {
            1: None,
            2: None,
            3: profile.INPUT_IS_BLANK,
            4: profile.INPUT_IS_NULL,
            5: profile.NOTHING_READABLE,
            6: None,
            7: None,
        }
        assert rows[1].predicted_label == "Sports" and rows[2].predicted_label == "Tech" and rows[7].predicted_label == "Politics"
        for i, r in rows.items():
            if r.error:
                assert r.predicted_label is None and r.top_predictions is None
                continue
            shown = [e.probability for e in r.top_predictions]
            assert len(shown) == 3 and shown == sorted(shown, reverse=True)
            assert r.top_predictions[0].label == r.predicted_label and r.predicted_probability == shown[0]
            assert r.confidence_percentage == r.top_predictions[0].percentage and r.confidence_percentage.endswith("%")
            assert math.isclose(sum(r.all_class_probabilities.values()), 1, abs_tol=4e-4)
            assert len(r.all_class_probabilities) == 4


def test_top_k_is_cut_to_the_classes(models, inputs):
    assert {len(r.top_predictions) for r in scoring.score_batch(models[0], inputs, top_k=99).filter("error is null").collect()} == {4}


def test_explanations(models, inputs):
    for model in models:
        predicted = {r.ID: r for r in scoring.score_batch(model, inputs).collect()}
        weights = {r.term: r.weights for r in model.terms.collect()}
        for r in scoring.score_and_explain(model, inputs, top_n=2).collect():
            p = predicted[r.ID]
            assert (r.error, r.predicted_label, r.predicted_probability) == (p.error, p.predicted_label, p.predicted_probability)
            if r.error:
                assert r.top_contributing_features is None and r.disclaimer is None
                continue
            entries = r.all_present_features
            assert r.features_present_count == len(entries)
            shown = [(-e.contribution, e.term) for e in entries]
            assert shown == sorted(shown)
            at = model.labels.index(r.predicted_label)
            for e in entries:
                assert all(word in r.Cleaned_Text for word in e.term.split())
                assert e.coefficient == pytest.approx(weights[e.term][at], abs=5e-5)
                assert e.contribution == pytest.approx(e.tfidf * e.coefficient, abs=3e-4)
                assert e.is_positive == (e.contribution >= 0) or e.contribution == 0
            positive = [e for e in entries if e.contribution > 0]
            assert r.top_contributing_features == (positive or entries)[:2]
            if r.ID == 6:
                assert entries == [] and r.top_contributing_features == []


def test_explain_record(models, inputs):
    record = scoring.explain_only(models[1], inputs)
    assert record.columns == [
        "ID", "predicted_category", "model_probability", "features_present_count",
        "top_contributing_features", "all_present_features", "error", "disclaimer",
    ]
    best = record.filter("ID = 2").first()
    assert best.top_contributing_features[0].term in {"5g", "स्मार्टफोन", "लाँच", "किंमत", "नवीन"}


def test_texts_keep_their_order(spark, models):
    table = scoring.texts_table(spark, ["विजय", "  ", "नवीन 5G स्मार्टफोन"])
    rows = scoring.score_batch(models[0], table).orderBy("ID").collect()
    assert [r.predicted_label for r in rows] == ["Sports", None, "Tech"] and rows[1].error == profile.INPUT_IS_BLANK


def test_jobs(spark, headlines, tmp_path):
    corpus_path, data, model = (str(tmp_path / n) for n in ("corpus", "data", "model"))
    headlines.drop("Cleaned_Text").write.parquet(corpus_path)
    labels = sorted({r.Label for r in headlines.collect()})
    jobs.main(["prepare", "--corpus", corpus_path, "--out", data, "--test-size", "0.3", "--labels", *labels])
    jobs.main(["evaluate", "--data", data, "--out", str(tmp_path / "reports")])
    jobs.main(["produce", "--data", data, "--out", model])
    jobs.main(["score", "--model", model, "--texts", corpus_path, "--out", str(tmp_path / "scores"), "--explain"])
    scored = spark.read.parquet(str(tmp_path / "scores"))
    assert scored.count() == 13 and scored.filter("size(top_contributing_features) = 0").count() == 0
    assert len(jobs.parser().parse_args(["compare", "--data", "a", "--out", "b"]).data) == 1


def test_report(spark, models, tmp_path):
    rows = spark.createDataFrame([(1, 'विजय "मोठा" विजय'), (2, " ")], "ID long, Text string")
    scored = scoring.score_batch(models[0], rows)
    report = export.prediction_report(scored, at=F.timestamp_seconds(F.lit(0)))
    assert report.columns == export.REPORT_COLUMNS
    export.write_prediction_report(report, str(tmp_path / "r"))
    lines = [line for f in (tmp_path / "r").glob("part-*") for line in f.read_text(encoding="utf-8").splitlines()]
    data = [line for line in lines if not line.startswith('\ufeff') and "Headline" not in line]
    assert len(data) == 1 and any(line.startswith("\ufeff") for line in lines)
    assert data[0].startswith('"विजय ""मोठा"" विजय","Sports","') and data[0].endswith('"1970-01-01T00:00:00.000Z"')


def test_stream_equals_batch(spark, models, tmp_path):
    source = tmp_path / "in"
    payloads = [(i, json.dumps({"headline": t}, ensure_ascii=False)) for i, t in TEXTS] + [(8, "not json"), (9, '{"other": 1}')]
    for k, part in enumerate((payloads[:4], payloads[4:])):
        spark.createDataFrame(part, "ID long, value string").coalesce(1).write.mode("append").json(str(source))
        stream = spark.readStream.schema("ID long, value string").json(str(source))
        query = start_scoring(
            models[0], parse_payload(stream).drop("value"), str(tmp_path / "out"), str(tmp_path / "state"), available_now=True
        )
        query.awaitTermination()
    got = {r.ID: (r.predicted_label, r.predicted_probability, r.error) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    rows = spark.createDataFrame([*TEXTS, (8, None), (9, None)], "ID long, Text string")
    want = {r.ID: (r.predicted_label, r.predicted_probability, r.error) for r in scoring.score_batch(models[0], rows).collect()}
    assert got == want and got[8][2] == profile.INPUT_IS_NULL


def test_a_new_checkpoint_loses_no_earlier_output(spark, models, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    spark.createDataFrame([(1, json.dumps({"headline": TEXTS[0][1]}))], "ID long, value string").write.json(str(source))
    for state in ("first", "second"):
        stream = spark.readStream.schema("ID long, value string").json(str(source))
        texts = parse_payload(stream).drop("value")
        start_scoring(models[0], texts, str(out), str(tmp_path / state), available_now=True).awaitTermination()
    assert [r.ID for r in spark.read.parquet(str(out)).collect()] == [1, 1]


def test_repeated_and_missing_ids_keep_their_own_scores(spark, models):
    texts = [t for _, t in TEXTS]
    alone = scoring.score_batch(models[0], scoring.texts_table(spark, texts)).collect()
    table = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)], "ID long, Text string")
    both = (scoring.score_batch(models[0], table), scoring.score_and_explain(models[0], table))
    key = lambda r: (str(r.Text), str(r.predicted_label), str(r.predicted_probability), str(r.error))
    for together in both:
        assert sorted(map(key, together.collect())) == sorted(map(key, alone))


def test_recent_predictions(spark):
    log = spark.createDataFrame([(s, t, t) for s in "ab" for t in range(30)], "session string, at int, seq int")
    rows = recent_predictions(log, "session", "at", "seq", n=20).collect()
    assert len(rows) == 40
    for s in "ab":
        assert [r["at"] for r in sorted((r for r in rows if r.session == s), key=lambda r: r.position)] == list(range(29, 9, -1))
