from __future__ import annotations

import random
import zlib

import pytest

from textloom.llm.quality import QualityConfig, fit_quality, score_quality
from textloom.llm.toxicity import ToxicityConfig, ToxicityModel, fit_toxicity, label_model, score_toxicity
from tests.llm.conftest import texts


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus(spark, make_docs):
    rng, pairs, labels = random.Random(2), [], []
    for i, t in enumerate(texts(40, 300)):
        poor, toxic = rng.random() < 0.3, rng.random() < 0.25
        words = t.split()
        if poor:
            words = [w + "%%%" for w in words]
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "brakko" + rng.choice("abcdef"), "brakkoly"])
        pairs.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic)))
    labels += [(None, 1, 1), (5, None, None), (99_999, 1, 1), (labels[7])]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS label", "1 AS text")
    return pairs, {i: (q, t) for i, q, t in labels[:300]}, table


def test_quality_on_rows_not_learned_from(make_docs, awkward, corpus):
    pairs, truth, labels = corpus
    rows = score_quality(make_docs(pairs + awkward), labels).collect()
    assert len(rows) == len(pairs) + len(awkward)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(r.doc_id) for r in rows)
    tested = [r for r in rows[: len(pairs)] if r.held_out]
    assert len(tested) > 30 and sum(r.predicted == truth[r.doc_id][0] for r in tested) >= 0.95 * len(tested)
    again = score_quality(make_docs(pairs + awkward).repartition(7), labels, config=QualityConfig()).collect()
    assert sorted((repr(r.doc_id), round(r.score, 9)) for r in rows) == sorted((repr(r.doc_id), round(r.score, 9)) for r in again)


def test_toxicity_on_rows_not_learned_from(make_docs, awkward, corpus):
    pairs, truth, labels = corpus
    rows = score_toxicity(make_docs(pairs + awkward), labels).collect()
    assert len(rows) == len(pairs) + len(awkward)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held(r.doc_id) for r in rows)
    tested = [r for r in rows[: len(pairs)] if r.held_out]
    assert sum(r.predicted == truth[r.doc_id][1] for r in tested) >= 0.95 * len(tested)
    assert not any(r.predicted for r in rows[len(pairs) :])


def test_held_out_labels_do_not_matter(spark, make_docs, corpus):
    pairs, truth, labels = corpus
    turned = spark.createDataFrame(
        [(i, 1 - q if held(i) else q, 1 - t if held(i) else t) for i, (q, t) in truth.items()], "doc_id long, quality int, toxic int"
    )
    plain = spark.createDataFrame([(i, q, t) for i, (q, t) in truth.items()], "doc_id long, quality int, toxic int")
    for score in (score_quality, score_toxicity):
        a, b = (score(make_docs(pairs), x).collect() for x in (plain, turned))
        assert [r.score for r in a] == [r.score for r in b]


def test_without_labels_or_documents(make_docs, corpus):
    pairs, _, labels = corpus
    none = labels.limit(0)
    assert {r.score for r in score_quality(make_docs(pairs[:20]), none).collect()} == {0.5}
    assert score_quality(make_docs([]), labels).collect() == [] and score_toxicity(make_docs([]), none).collect() == []
    rows = score_toxicity(make_docs([(1, "you idiot, you worthless scum"), (2, "a fine day")]), none).collect()
    assert rows[0].score > rows[1].score
    model = fit_toxicity(make_docs([]).select("doc_id", "text"), none)
    assert isinstance(model, ToxicityModel) and model.score("idiot scum") > 0.5 > model.score("nothing of it")


def test_label_model_discounts_voters_that_repeat_each_other():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    good = [np.where(truth, rng.random(4000) < 0.7, rng.random(4000) < 0.02) for _ in range(3)]
    noise = np.where(truth, rng.random(4000) < 0.3, rng.random(4000) < 0.2)
    votes = np.stack([*good, *[noise] * 20], axis=1)
    posterior = label_model(votes, np.full(4000, -1), 0.3, ToxicityConfig())
    known = label_model(votes, np.where(rng.random(4000) < 0.2, truth, -1).astype(int), 0.3, ToxicityConfig())
    assert ((known >= 0.5) == truth).mean() > 0.93
    assert ((posterior >= 0.5) == truth).mean() > 0.5


def test_a_hot_id_counts_once(make_docs, corpus):
    """Rows of a sampled id are one in the sample, however many there are and whatever they hold."""
    pairs, truth, labels = corpus
    hot = next(i for i in truth if not held(i) and truth[i][1] == 0)
    docs, copied, other = (
        make_docs([*pairs, *more]).select("doc_id", "text")
        for more in ([], [(hot, dict(pairs)[hot])] * 300, [(hot, f"w1 w2 idiot scum {k}") for k in range(300)])
    )
    assert len(fit_quality(other, labels).labels) == len(fit_quality(docs, labels).labels)
    assert fit_toxicity(copied, labels).weights == fit_toxicity(docs, labels).weights


def test_neighbour_vote_against_single_cosines(spark):
    """Each score again, from one cosine at a time over the whole labelled sample."""
    import math

    from textloom.llm.quality import Features, QualityConfig, fit_quality, score_quality

    good, junk = texts(31, 120, 300), [" ".join(f"{w}!!{w}" for w in t.split()[::2]) for t in texts(32, 120, 30)]
    rows = [(i, t) for i, t in enumerate([t for pair in zip(good, junk, strict=True) for t in pair])] + [(900, None), (901, ""), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    config = QualityConfig(per_label=60, spanning=40, features=256, dimensions=8, neighbours=5)
    model = fit_quality(docs, labels, config)
    assert 60 < len(model.labels) <= 120 and len(model.vectors) == len(model.labels)
    features = Features(config.features)
    wanted = {}
    for i, text in rows:
        counts = features.counts(None if text is None else text.encode())
        weighted = [math.log1p(float(c)) * float(w) for c, w in zip(counts, model.idf, strict=True)]
        size = math.sqrt(sum(x * x for x in weighted)) or 1.0
        latent = [sum(x / size * float(p) for x, p in zip(weighted, column, strict=True)) for column in model.projection.T]
        size = math.sqrt(sum(x * x for x in latent)) or 1.0
        cosines = [max(0.0, round(sum(x / size * float(v) for x, v in zip(latent, vector, strict=True)), 5)) for vector in model.vectors]
        least = sorted(cosines)[-config.neighbours]
        votes = [(c**config.sharpness, y) for c, y in zip(cosines, model.labels, strict=True) if c >= least]
        total = sum(w for w, _ in votes)
        wanted.setdefault(i, []).append(sum(w * y for w, y in votes) / total if total else model.prior)
    got: dict = {}
    for r in score_quality(docs, labels, config=config).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert got.keys() == wanted.keys()
    # The operator counts in single precision, which moves a cosine of five decimals by one unit at most.
    assert all(abs(a - b) < 1e-3 for i in got for a, b in zip(sorted(got[i]), sorted(wanted[i]), strict=True))


def test_one_round_of_the_label_model_by_plain_loops():
    """Rates, correlations and posterior of a round, document by document."""
    import math

    import numpy as np

    from textloom.llm.toxicity import SIGNIFICANT, Votes, estimate, expected, together

    rng = np.random.default_rng(7)
    vectors, labels, n = [[], [0], [0, 1], [1, 2], [3], [0, 1, 3]], [-1, 1, 1, 0, 0, -1], [50, 7, 9, 4, 6, 3]
    order = rng.permutation(6)
    block = Votes.of([vectors[i] for i in order], [labels[i] for i in order], [n[i] for i in order])
    config = ToxicityConfig(rounds=1)
    model = estimate(lambda m: expected(block, m, 4, config), together(block, 4), 4, 0.3, config)
    docs = [(set(v), y) for v, y, k in zip(vectors, labels, n, strict=True) for _ in range(k)]
    guess = [0.95 if y == 1 else 0.05 if y == 0 else 0.7 if v else 0.05 for v, y in docs]
    yes, total = sum(guess), len(docs)
    a = [(sum(p for p, (v, _) in zip(guess, docs) if i in v) + 0.5) / (yes + 1) for i in range(4)]
    b = [(sum(1 - p for p, (v, _) in zip(guess, docs) if i in v) + 0.5) / (total - yes + 1) for i in range(4)]
    rest = [[(i in v) - p * a[i] - (1 - p) * b[i] for i in range(4)] for p, (v, _) in zip(guess, docs)]
    cov = [[sum(r[i] * r[j] for r in rest) / total for j in range(4)] for i in range(4)]
    weight = []
    for i in range(4):
        alike = [max(0.0, min(1.0, cov[i][j] / (math.sqrt(cov[i][i]) + 1e-9) / (math.sqrt(cov[j][j]) + 1e-9))) ** 2 for j in range(4)]
        weight.append(1 / (1 + sum(x for j, x in enumerate(alike) if j != i and x * total > SIGNIFICANT)))
    known = [(p if y == 1 else 1 - p) for p, (_, y) in zip(guess, docs) if y >= 0]
    accuracy = min(max(sum(known) / len(known), 0.6), 0.99)
    for i, posterior in zip(order, model.posterior(block), strict=True):
        logit = math.log(0.3 / 0.7)
        for j in range(4):
            logit += weight[j] * (math.log(a[j] / b[j]) if j in vectors[i] else math.log((1 - a[j]) / (1 - b[j])))
        logit += {1: 1, 0: -1, -1: 0}[labels[i]] * math.log(accuracy / (1 - accuracy))
        assert abs(posterior - 1 / (1 + math.exp(-logit))) < 1e-9


def test_votes_are_counted_over_all_documents(spark):
    """Counts of vote vectors in Spark equal those of single texts, and leave out the sampled ids."""
    from collections import Counter

    from textloom.llm.toxicity import LEXICON, _voted, patterns, stems, words_of

    rng = random.Random(9)
    pool = [*LEXICON[:6], "you", "plain", "words", "HERE", "NOW!", "!!"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in range(400)] + [(None, None), (None, "you are an IDIOT")]
    voters, sampled = [*LEXICON, "plai-"], {3, 5}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = docs.mapInArrow(lambda b: _voted(b, voters, sampled), "votes array<int>, n long").groupBy("votes").sum("n").collect()
    want: Counter = Counter()
    for i, text in rows:
        if i not in sampled:
            words = words_of(text)
            fired = {voters.index(s) for w in words for s in stems(w) if s in voters}
            want[tuple(sorted(fired | {len(voters) + k for k, yes in enumerate(patterns(text, words)) if yes}))] += 1
    assert {tuple(r.votes): r["sum(n)"] for r in got} == want
