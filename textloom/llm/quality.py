"""Quality classifier: votes of the nearest labelled documents in a latent space.

Documents are counts of hashed features: words, their shapes, repeated neighbours, and how
many words of a stretch are distinct. Document frequencies come from all documents. The
labelled sample spans a latent space (singular vectors of its weighted counts); its
vectors travel to the tasks, which multiply each document with all of them, in blocks, and
let the nearest vote by their cosines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.labelled import held_out, training_sample


@dataclass(frozen=True)
class QualityConfig:
    """``per_label`` bounds the labelled sample (rows per label), of which ``spanning`` rows make the latent
    space; ``features`` is the width of the hashing."""

    per_label: int = 2_000
    spanning: int = 1_500
    features: int = 4_096
    dimensions: int = 32
    neighbours: int = 15
    sharpness: int = 4
    threshold: float = 0.3


STRETCH = 32
# Words whose features a task remembers.
REMEMBERED = 200_000
_CLASSES = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)


class Features(dict):
    """Word to its two feature numbers in one: the word's in lower case, and that of its shape."""

    def __init__(self, width: int):
        super().__init__()
        self.width = width
        self.repeat = self._number(b"repeat")
        self.distinct = np.array([self._number(b"distinct %d" % i) for i in range(9)])

    def _number(self, name: bytes) -> int:
        return xxhash.xxh64_intdigest(name) % self.width

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        shape = bytearray()
        for c in word.translate(_CLASSES):
            if not shape or shape[-1] != c:
                shape.append(c)
        number = self._number(b"shape " + shape[:6]) * self.width + self._number(b"word " + word.lower())
        self[word] = number
        return number

    def counts(self, text: bytes | None) -> np.ndarray:
        """How often each feature is in a text."""
        words = (text or b"").split()
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        out = np.bincount(codes % self.width, minlength=self.width) + np.bincount(codes // self.width, minlength=self.width)
        if len(codes):
            out[self.repeat] += int((codes[1:] == codes[:-1]).sum())
            whole = len(codes) // STRETCH * STRETCH
            parts = np.sort(codes[:whole].reshape(-1, STRETCH), axis=1)
            distinct = ((parts[:, 1:] != parts[:, :-1]).sum(axis=1) + 1) * 8 // STRETCH
            np.add.at(out, self.distinct[distinct], STRETCH)
            rest = codes[whole:]
            if len(rest):
                out[self.distinct[len(np.unique(rest)) * 8 // len(rest)]] += STRETCH
        return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class NeighbourModel:
    """``projection`` takes weighted counts to the latent space, where ``vectors`` with ``labels`` lie."""

    config: QualityConfig
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts).astype(np.float32) * self.idf) @ self.projection)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, by cosine; all that tie with the last one vote too."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = np.maximum(np.round(self.latent(counts) @ self.vectors.T, 5), 0)
        k = min(self.config.neighbours, len(self.labels))
        least = np.partition(cosine, -k, axis=1)[:, -k][:, None]
        weight = np.where(cosine >= least, cosine**self.config.sharpness, 0).astype(np.float64)
        total = weight.sum(axis=1)
        return np.where(total > 0, weight @ self.labels / np.maximum(total, 1e-12), self.prior)


def _frequencies(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    features, seen = Features(width), np.zeros(width + 1, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            seen[:width] += features.counts(text.as_py()) > 0
        seen[width] += batch.num_rows
    yield pa.RecordBatch.from_pydict({"feature": pa.array(range(width + 1), pa.int32()), "n": pa.array(seen)})


def _sparse(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    features = Features(width)
    for batch in batches:
        counts = [features.counts(text.as_py()) for text in batch.column("text")]
        used = [np.flatnonzero(c).astype(np.int32) for c in counts]
        columns = {"doc_id": batch.column("doc_id"), "label": batch.column("label")}
        columns["features"] = pa.array([u.tolist() for u in used], pa.list_(pa.int32()))
        columns["counts"] = pa.array([c[u].tolist() for c, u in zip(counts, used, strict=True)], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict(columns)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature numbers and counts of a row as two byte strings."""
    for batch in batches:
        rows = batch.column("counts").to_pylist()
        columns = {"doc_id": batch.column("doc_id"), "label": batch.column("label")}
        for name, kind in (("feature", np.int32), ("n", np.int64)):
            columns[name] = pa.array([np.array([c[name] for c in row], kind).tobytes() for row in rows], pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


@dataclass(frozen=True)
class Sample:
    """The labelled sample, packed: a few bytes for each feature a row has, never a dense row for all of them."""

    width: int
    features: list[bytes]
    counts: list[bytes]
    labels: np.ndarray

    def dense(self, rows: range) -> np.ndarray:
        out = np.zeros((len(rows), self.width), np.float32)
        for i, row in enumerate(rows):
            out[i, np.frombuffer(self.features[row], np.int32)] = np.frombuffer(self.counts[row], np.int64)
        return out


def latent_space(sample: Sample, idf: np.ndarray, prior: float, config: QualityConfig, block: int = 256) -> NeighbourModel:
    """The singular vectors of ``spanning`` rows of the sample, and where all its rows lie among them. Only the
    spanning rows are dense at once."""
    rows = len(sample.labels)
    projection = np.zeros((sample.width, 0), np.float32)
    if rows:
        some = sample.dense(range(0, rows, -(-rows // config.spanning)))
        np.log1p(some, out=some)
        some *= idf
        some /= np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-9)
        values, left = np.linalg.eigh((some @ some.T).astype(np.float64))
        top = [i for i in np.argsort(-values)[: config.dimensions] if values[i] > 1e-6]
        projection = (some.T @ (left[:, top] / np.sqrt(values[top])).astype(np.float32)).astype(np.float32)
        del some
    model = NeighbourModel(config, idf, projection, np.zeros((0, 0), np.float32), sample.labels, prior)
    vectors = [model.latent(sample.dense(range(at, min(rows, at + block)))).astype(np.float32) for at in range(0, rows, block)]
    return replace(model, vectors=np.concatenate(vectors) if vectors else model.vectors)


def fit_quality(documents: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig(), label: str = "quality") -> NeighbourModel:
    """Document frequencies over all of ``documents(doc_id, text)``; latent vectors of the labelled sample."""
    width = config.features
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(lambda b: _frequencies(b, width), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    seen = np.zeros(width + 1)
    for row in counted.collect():  # a row per feature
        seen[row.feature] = row.n
    idf = (np.log((1 + seen[width]) / (1 + seen[:width])) + 1).astype(np.float32)
    sample, share = training_sample(labels, label, config.per_label)
    found = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    found = found.mapInArrow(lambda b: _sparse(b, width), "doc_id long, label int, features array<int>, counts array<long>")
    # Rows of one id count together, so the driver gets a row per sampled id.
    pair = F.explode_outer(F.arrays_zip("features", "counts")).alias("f")
    summed = found.select("doc_id", "label", pair).groupBy("doc_id", "label", F.col("f.features").alias("feature")).agg(F.sum("f.counts").alias("n"))
    summed = summed.groupBy("doc_id", "label").agg(F.collect_list(F.when(F.col("feature").isNotNull(), F.struct("feature", "n"))).alias("counts"))
    packed = summed.mapInArrow(_packed, "doc_id long, label int, feature binary, n binary")
    rows = sorted(packed.collect(), key=lambda r: r.doc_id)  # the bounded sample
    labelled = Sample(width, [bytes(r.feature) for r in rows], [bytes(r.n) for r in rows], np.array([r.label for r in rows], np.float64))
    del rows
    return latent_space(labelled, idf, share, config)


def _score(batches: Iterator[pa.RecordBatch], model: NeighbourModel, block: int = 512) -> Iterator[pa.RecordBatch]:
    features = Features(model.config.features)
    for batch in batches:
        scores = [
            model.scores(np.stack([features.counts(t.as_py()) for t in batch.column("text")[at : at + block]]))
            for at in range(0, batch.num_rows, block)
        ]
        scores = np.clip(np.concatenate(scores), 0, 1) if scores else np.zeros(0)
        predicted = (scores >= model.config.threshold).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores), "predicted": pa.array(predicted)})


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    config: QualityConfig = QualityConfig(),
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row; labels come by ``doc_id`` from rows not held out.

    Defined cases: null, empty and blank texts, and texts unlike all labelled ones, get the
    share of label 1 among the training labels, 0.5 without any. A null id is not held out.
    Repeated ids keep their rows. Of several labels of an id the mean counts. An empty table
    gives an empty table. Other columns are not read.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    model = documents.sparkSession.sparkContext.broadcast(fit_quality(rows, labels, config, label_column))
    texts = rows.select("doc_id", F.col("text").cast("binary").alias("text"))
    scored = texts.mapInArrow(lambda b: _score(b, model.value), "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
