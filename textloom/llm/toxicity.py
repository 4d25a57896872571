"""Toxicity by weak supervision.

Many voters look at a document: words of a small lexicon, words and word beginnings that the
training labels make suspicious, patterns, and the label itself where there is one for
training. Which voters fire together is counted over all documents. On these counts a generative
label model estimates by expectation maximisation how often each voter fires in toxic and in clean
documents, how right the labels are, and how far voters repeat each other beyond that; a
voter that repeats others counts for less. Its posterior on the labelled documents trains a linear
classifier on words and word beginnings, which scores all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.labelled import held_out, training_sample
from textloom.storage import materialise

LEXICON = (
    "idiot moron imbecile stupid dumb loser scum trash garbage worthless pathetic disgusting clown fool "
    "freak creep filthy vermin bastard jerk ugly retard hate kill"
).split()
LETTERS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
# Words whose stems a task remembers.
REMEMBERED = 200_000


@dataclass(frozen=True)
class ToxicityConfig:
    """``per_label`` bounds the labelled sample (rows per label). A stem is a voter, or a feature of the classifier, if its
    likelihood ratio against one common rate is ``evidence`` or ``feature_evidence``; ``rounds`` bounds the estimation, which
    stops when no rate moves by ``settled``."""

    per_label: int = 3_000
    evidence: float = 30.0
    feature_evidence: float = 10.0
    rounds: int = 15
    settled: float = 1e-3
    label_accuracy: float = 0.95
    ridge: float = 1.0
    lexicon_weight: float = 1.5
    threshold: float = 0.5


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall((text or "").lower()))


def stems(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a dash."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


CAPITALS = re.compile("[A-Z\u00c0-\u00de\u0391-\u03a9\u0400-\u042f]{3}")
INSULTED = re.compile(rf"\byou\b\W+(?:\w+\W+){{0,3}}(?:{'|'.join(LEXICON)})\b", re.IGNORECASE)


def patterns(text: str | None, words: set[str]) -> list[bool]:
    """Shouting, many exclamation marks, and an insult from the lexicon near ``you``; ``words`` are the text's in lower case."""
    text = text or ""
    loud = marks = False
    if CAPITALS.search(text):
        written = LETTERS.findall(text)
        loud = sum(len(w) > 2 and w.isupper() for w in written) * 3 > len(written)
    if words and "!" in text:
        marks = text.count("!") * 10 > len(LETTERS.findall(text))
    near = "you" in words and not words.isdisjoint(LEXICON) and INSULTED.search(text) is not None
    return [loud, marks, near]


N_PATTERNS = 3


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column("text")]
        found = [words_of(t) for t in texts]
        held = [sorted({s for w in words for s in stems(w)}) for words in found]
        shapes = [patterns(t, words) for t, words in zip(texts, found, strict=True)]
        columns = {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "stems": pa.array(held, pa.list_(pa.string()))}
        yield pa.RecordBatch.from_pydict(columns | {"patterns": pa.array(shapes, pa.list_(pa.bool_()))})


def _active(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Numbers of the chosen stems that each sampled document has."""
    numbers = {s: i for i, s in enumerate(names)}
    for batch in batches:
        active = [[numbers[s] for s in held if s in numbers] for held in batch.column("stems").to_pylist()]
        yield batch.select(["doc_id", "label", "patterns"]).append_column("active", pa.array(active, pa.list_(pa.int32())))


# Vote vectors that a task counts before it sends them on.
VECTORS = 50_000


def _voted(batches: Iterator[pa.RecordBatch], voters: list[str], sampled: set[int]) -> Iterator[pa.RecordBatch]:
    """How often each set of voters fires in the documents that are not in the sample."""
    numbers = {s: i for i, s in enumerate(voters)}
    remembered: dict[str, tuple[int, ...]] = {}
    counts: Counter[tuple[int, ...]] = Counter()

    def flushed() -> pa.RecordBatch:
        kinds = pa.list_(pa.int32()), pa.int64()
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((list(counts), list(counts.values())), kinds, strict=True)], ["votes", "n"])
        counts.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            if doc_id in sampled:
                continue
            text = text.as_py()
            words = words_of(text)
            fired: set[int] = set()
            for word in words:
                known = remembered.get(word)
                if known is None:
                    if len(remembered) >= REMEMBERED:
                        remembered.clear()
                    known = remembered[word] = tuple(numbers[s] for s in stems(word) if s in numbers)
                if known:
                    fired.update(known)
            fired.update(len(voters) + i for i, yes in enumerate(patterns(text, words)) if yes)
            counts[tuple(sorted(fired))] += 1
            if len(counts) >= VECTORS:
                yield flushed()
    yield flushed()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _told_apart(counts: DataFrame) -> DataFrame:
    """``counts(stem, k, o)`` without the stems that the same documents have as their next shorter beginning: a
    beginning is in all documents of the longer one, so equal counts mean the same documents."""
    whole = ~F.col("stem").endswith("-")
    size = F.char_length("stem") - F.when(whole, 0).otherwise(1)
    ends = F.array(*[F.lit(n) for n in BEGINNINGS])
    below = F.array_max(F.filter(ends, lambda n: n < size))
    shorter = counts.withColumn("_shorter", F.when(below.isNotNull(), F.concat(F.left("stem", below), F.lit("-"))))
    other = counts.select(F.col("stem").alias("_shorter"), F.col("k").alias("_k"), F.col("o").alias("_o"))
    same = F.coalesce((F.col("k") == F.col("_k")) & (F.col("o") == F.col("_o")), F.lit(False))
    return shorter.join(other, "_shorter", "left").filter(~same).select("stem", "k", "o")


def chosen_stems(sample: DataFrame, config: ToxicityConfig) -> tuple[list[str], list[str]]:
    """Stems for the voters, and stems for the classifier, out of ``sample(doc_id, label, stems)`` with labels 1, 0 or -1.
    Rows of one id count as one.

    A voter is a stem that toxic documents have far more often than clean ones, with a
    likelihood ratio of ``evidence`` against one common rate, as many stems are tried. The
    classifier also gets what else tells the labels apart best.
    """
    rows = {r.label: r.n for r in sample.groupBy("label").agg(F.count_distinct("doc_id").alias("n")).collect()}
    n, m = rows.get(1, 0), rows.get(0, 0)
    if not n or not m:
        return [], []
    known = sample.filter("label >= 0").select("doc_id", "label", F.explode("stems").alias("stem")).distinct()
    counts = known.groupBy("stem").agg(F.sum("label").alias("k"), F.sum(1 - F.col("label")).alias("o")).filter("k + o >= 3")
    counts = materialise(_told_apart(materialise(counts, "stem-counts")), "stems-told-apart")
    k, o = F.col("k").cast("double"), F.col("o").cast("double")

    def part(seen, share):
        return F.when(seen > 0, seen * F.log(F.greatest(seen, F.lit(1.0)) / ((k + o) * share))).otherwise(0.0)

    ratio = F.round(2 * (part(k, F.lit(n / (n + m))) + part(o, F.lit(m / (n + m)))), 6)
    ranked = counts.withColumn("ratio", ratio).orderBy(F.desc("ratio"), "stem")
    voters = ranked.filter((k / n > 4 * (o + 0.5) / m) & (F.col("ratio") >= config.evidence))
    others = ranked.filter((k + o >= 10) & (F.col("ratio") >= config.feature_evidence))
    # No more than a bounded sample has stems, and far fewer.
    return [r.stem for r in voters.collect()], [r.stem for r in others.collect()]


@dataclass(frozen=True)
class Votes:
    """Vote vectors with the label (1, 0 or -1 for none) and how many documents have them: ``flat`` voters of all vectors in a row,
    ``rows`` the vector of each."""

    rows: np.ndarray
    flat: np.ndarray
    labels: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, votes: list, labels, n) -> Votes:
        sizes = np.array([len(v) for v in votes], np.int64)
        flat = np.array([x for v in votes for x in v], np.int64)
        return cls(np.repeat(np.arange(len(votes)), sizes), flat, np.asarray(labels), np.asarray(n, np.float64))

    def summed(self, of_voter: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, of_voter[self.flat], minlength=len(self.n))

    def per_voter(self, of_vector: np.ndarray, voters: int) -> np.ndarray:
        return np.bincount(self.flat, of_vector[self.rows], minlength=voters)


@dataclass(frozen=True)
class LabelModel:
    """What a vote adds to the log odds of label 1, where all are silent, and how right the training labels are."""

    delta: np.ndarray
    silent: float
    accuracy: float

    def posterior(self, votes: Votes) -> np.ndarray:
        logit = self.silent + votes.summed(self.delta)
        sure = np.log(self.accuracy / (1 - self.accuracy))
        return _sigmoid(logit + np.where(votes.labels < 0, 0, np.where(votes.labels == 1, sure, -sure)))


def _first_guess(votes: Votes, config: ToxicityConfig) -> np.ndarray:
    fired = votes.summed(np.ones(int(votes.flat.max(initial=0)) + 1)) > 0
    told = np.where(votes.labels == 1, config.label_accuracy, 1 - config.label_accuracy)
    return np.where(votes.labels >= 0, told, np.where(fired, 0.7, 0.05))


def expected(votes: Votes, model: LabelModel | None, voters: int, config: ToxicityConfig) -> np.ndarray:
    """The sums that a round needs of a block: documents of label 1, their squares, agreement with known labels, known labels,
    and documents of label 1 by voter."""
    p = _first_guess(votes, config) if model is None else model.posterior(votes)
    known = votes.labels >= 0
    agree = np.where(votes.labels == 1, p, 1 - p)
    head = [votes.n @ p, votes.n @ (p * p), (votes.n * agree)[known].sum(), votes.n[known].sum()]
    return np.concatenate([head, votes.per_voter(votes.n * p, voters)])


def together(votes: Votes, voters: int) -> np.ndarray:
    """Documents, documents by voter, documents by pair of voters; the same in all rounds."""
    pairs = np.zeros((voters, voters))
    starts = np.searchsorted(votes.rows, np.arange(len(votes.n) + 1))
    for i in range(len(votes.n)):
        own = votes.flat[starts[i] : starts[i + 1]]
        pairs[np.ix_(own, own)] += votes.n[i]
    return np.concatenate([[votes.n.sum()], pairs.ravel()])


# A correlation counts from here on: chi squared of one degree at a thousandth.
SIGNIFICANT = 10.83


def estimate(step, counted: np.ndarray, voters: int, prior: float, config: ToxicityConfig) -> LabelModel | None:
    """Expectation maximisation. ``step`` gives the sums of :func:`expected` over all documents for a model, ``counted`` are those of
    :func:`together`. Without documents there is no model."""
    total, pairs = counted[0], counted[1:].reshape(voters, voters)
    if not total:
        return None
    model, accuracy, rates = None, config.label_accuracy, None
    seen = np.diag(pairs)
    for _ in range(config.rounds):
        yes, squares, agree, known, *fired = step(model)
        fired = np.array(fired)
        no = total - yes
        a, b = (fired + 0.5) / (yes + 1), (seen - fired + 0.5) / (no + 1)
        # What two voters have in common within the classes makes them repeat each other.
        mixed = yes - squares
        cross = np.outer(fired, a) + np.outer(seen - fired, b)
        means = squares * np.outer(a, a) + mixed * (np.outer(a, b) + np.outer(b, a)) + (total - 2 * yes + squares) * np.outer(b, b)
        shared = (pairs - cross - cross.T + means) / total
        spread = np.sqrt(np.maximum(np.diag(shared), 0)) + 1e-9
        alike = np.clip(shared / np.outer(spread, spread), 0, 1) ** 2
        np.fill_diagonal(alike, 1)
        weight = 1 / np.where(alike * total > SIGNIFICANT, alike, np.eye(voters)).sum(axis=1)
        if known:
            accuracy = float(np.clip(agree / known, 0.6, 0.99))
        fires, silent = np.log(a / b) * weight, np.log((1 - a) / (1 - b)) * weight
        model = LabelModel(fires - silent, float(np.log(prior / (1 - prior)) + silent.sum()), accuracy)
        if rates is not None and max(np.abs(a - rates[0]).max(), np.abs(b - rates[1]).max()) < config.settled:
            break
        rates = a, b
    return model


def label_model(votes: np.ndarray, labels: np.ndarray, prior: float, config: ToxicityConfig) -> np.ndarray:
    """The posterior of label 1 per document, from ``votes[document, voter]`` and labels 1, 0 or -1 that are in memory."""
    block = Votes.of([np.flatnonzero(v) for v in votes], labels, np.ones(len(votes)))
    voters = votes.shape[1]
    model = estimate(lambda m: expected(block, m, voters, config), together(block, voters), voters, prior, config)
    return np.zeros(0) if model is None else model.posterior(block)


def _over(table: DataFrame, sums, size: int) -> np.ndarray:
    """``sums`` of every block of ``table(label, votes, n)``, added up: a fixed number of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += sums(Votes.of(batch.column("votes").to_pylist(), batch.column("label").to_numpy(), batch.column("n").to_numpy()))
        at = np.flatnonzero(total).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "x"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array([batch.column(c).to_numpy().tobytes()], pa.binary()) for c in ("at", "x")]
            yield pa.RecordBatch.from_arrays(columns, ["at", "x"])

    summed = table.mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x"))
    out = np.zeros(size)
    for row in summed.mapInArrow(packed, "at binary, x binary").collect():  # at most twelve bytes a number
        out[np.frombuffer(row.at, np.int32)] = np.frombuffer(row.x)
    return out


def linear_fit(x: np.ndarray, target: np.ndarray, start: np.ndarray, ridge: float, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps; weights are drawn to ``start``, the bias to nothing."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    drawn = np.append(start, 0.0)
    w = drawn.copy()
    for _ in range(rounds):
        p = _sigmoid((x @ w.astype(x.dtype)).astype(np.float64))
        curve = np.maximum(p * (1 - p), 1e-4).astype(x.dtype)
        hessian = (x.T @ (x * curve[:, None])).astype(np.float64)
        hessian[np.diag_indices_from(hessian)] += penalty
        gradient = ((p - target).astype(x.dtype) @ x).astype(np.float64) + penalty * (w - drawn)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def dividing_line(z: np.ndarray, y: np.ndarray, share: float) -> float:
    """Where training labels are told apart with the fewest errors, given the share of label 1 in the corpus; the middle of the best places."""
    order = np.argsort(z, kind="stable")
    z, cost = z[order], np.where(y[order] == 1, share / (y == 1).sum(), -(1 - share) / (y == 0).sum())
    errors = np.cumsum(cost)[:-1]  # a line behind the i-th loses the toxic ones before it and clears the clean ones
    errors = np.where(z[1:] > z[:-1], errors, np.inf)
    if not np.isfinite(errors).any():
        return 0.0
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float((z[best[0]] + z[best[-1] + 1]) / 2)


@dataclass(frozen=True)
class ToxicityModel:
    config: ToxicityConfig
    weights: dict[str, float]
    bias: float
    _remembered: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False, compare=False)

    def score(self, text: str | None) -> float:
        active: set[str] = set()
        remembered = self._remembered
        for word in words_of(text):
            known = remembered.get(word)
            if known is None:
                if len(remembered) >= REMEMBERED:
                    remembered.clear()
                known = remembered[word] = tuple(s for s in stems(word) if s in self.weights)
            if known:
                active.update(known)
        return float(_sigmoid(np.float64(self.bias + sum(self.weights[s] for s in sorted(active)))))


def fit_toxicity(documents: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig(), label: str = "toxic") -> ToxicityModel:
    """Stems and classifier from the labelled sample, which is bounded; the label model from the votes on all of
    ``documents(doc_id, text)``. The driver gets a row per sampled id, the stems with evidence, and sums by voter and pair of voters."""
    sample, share = training_sample(labels, label, config.per_label)
    texts = documents.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    kind = "doc_id long, label int, stems array<string>, patterns array<boolean>"
    held = materialise(texts.mapInArrow(_sampled, kind), "toxicity-sample")
    voters, others = chosen_stems(held, config)
    voters = list(dict.fromkeys([*LEXICON, *voters]))
    names = [*voters, *sorted(set(others) - set(voters))]
    found = held.mapInArrow(lambda b: _active(b, names), "doc_id long, label int, patterns array<boolean>, active array<int>")
    # Rows of one id count together, so the driver gets a row per sampled id.
    fired = F.array(*[F.max(F.col("patterns")[i]) for i in range(N_PATTERNS)]).alias("patterns")
    found = found.select("doc_id", "label", "patterns", F.explode_outer("active").alias("stem"))
    found = found.groupBy("doc_id", "label").agg(fired, F.sort_array(F.collect_set("stem")).alias("active"))
    rows = sorted(found.collect(), key=lambda r: r.doc_id)  # the bounded sample
    if not rows:
        return ToxicityModel(config, {s: 4.0 for s in LEXICON}, -2.0)
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, row in enumerate(rows):
        x[i, row.active] = 1
    y = np.array([r.label for r in rows], np.int64)
    size = len(voters) + N_PATTERNS
    own = [[v for v in r.active if v < len(voters)] + [len(voters) + i for i, yes in enumerate(r.patterns) if yes] for r in rows]
    sampled = documents.sparkSession.sparkContext.broadcast({r.doc_id for r in rows})
    votes = documents.select("doc_id", "text").mapInArrow(lambda b: _voted(b, voters, sampled.value), "votes array<int>, n long")
    votes = votes.groupBy("votes").agg(F.sum("n").alias("n")).select(F.lit(-1).alias("label"), "votes", "n")
    votes = materialise(votes, "toxicity-votes")
    labelled = Votes.of(own, y, np.ones(len(y)))
    counted = _over(votes, lambda b: together(b, size), 1 + size * size) + together(labelled, size)

    def step(model: LabelModel | None) -> np.ndarray:
        return _over(votes, lambda b: expected(b, model, size, config), 4 + size) + expected(labelled, model, size, config)

    balance = float((y == 1).sum() + 0.5) / float(len(y) + 1)
    model = estimate(step, counted, size, balance, config)
    return learned(x, y, model.posterior(labelled), names, share, config)


def learned(x: np.ndarray, y: np.ndarray, posterior: np.ndarray, names: list[str], share: float, config: ToxicityConfig) -> ToxicityModel:
    """The classifier from which stems labelled documents have, their labels, and the label model's posterior on them;
    ``share`` is that of label 1 in the corpus."""
    start = np.where(np.isin(names, LEXICON), config.lexicon_weight, 0.0)
    weights, bias = linear_fit(x, posterior, start, config.ridge)
    if (y == 0).any() and (y == 1).any():
        bias -= dividing_line(x @ weights + bias, y, min(max(share, 1e-3), 1 - 1e-3))
    return ToxicityModel(config, {s: float(w) for s, w in zip(names, weights, strict=True) if abs(w) > 1e-4}, float(bias))


def _score(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.array([model.score(t.as_py()) for t in batch.column("text")], np.float64)
        predicted = (scores >= model.config.threshold).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores), "predicted": pa.array(predicted)})


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    config: ToxicityConfig = ToxicityConfig(),
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row; labels come by ``doc_id`` from rows not held out.

    Defined cases: null, empty and wordless texts get the score of no evidence. Without any
    labelled document to learn from, the lexicon decides. In the label model rows of one sampled id are one document, all
    other rows one each. A null id is not held out. Repeated ids keep
    their rows. Of several labels of an id the mean counts. An empty table gives an empty
    table. Other columns are not read.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    model = documents.sparkSession.sparkContext.broadcast(fit_toxicity(rows, labels, config, label_column))
    scored = rows.mapInArrow(lambda b: _score(b, model.value), "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
