"""Linear models whose coefficients never come together: training over features cut by term.

Every vector that training meets, weights, gradients and steps alike, is a sum of documents' features: ``X' a`` with
a number per document and class. So training keeps the factors ``a`` and the margins ``X X' a`` per document, never a
vector per term. The features are stored once in cells, a chunk of documents by a part of the terms, bucketed by part.
A step takes the factors of the new gradient to the parts, where the gradient of the part's terms is summed
and multiplied back to margins; what is shuffled is a row of numbers per document and part, never a feature.

All steps run inside one stage (``one_stage``) where its tasks can run at once. Elsewhere, as under dynamic allocation or with a
shared folder that only Spark reaches, every pass is a Spark job, as described here.

Steps are Newton's, each found by conjugate gradients: a product with the curvature takes one number per document and
class to the parts and back, and its factors are known where the margins are. All that a step needs of five vectors are
their inner products, sums over documents of factors times margins. Those, the loss and the intercepts' part
are what the driver sees, whatever the size of the vocabulary. Margins are linear in the coefficients, so where a whole
step is too long, others are tried on stored margins without touching the features.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.operators.classifier import TextClassifier, class_counts
from textloom.operators.one_stage import LENGTHS, MAX_PRODUCTS, Problem, runs_together, tasks_for, trained
from textloom.operators.tfidf import TfidfConfig, TfidfModel, content_column, fit_tfidf, known_rows
from textloom.sizing import SALTS
from textloom.storage import delete_folder, materialise, new_path

DOC, SALT, CHUNK, PART = "_doc", "_salt", "_chunk", "_part"
# Documents of a chunk: 1,024. Numbers start over in every partition, so a chunk lies in one.
CHUNK_BITS = 10
# A part's features, 14 bytes each, are in one task together; there are so many parts that they have this size.
PART_BYTES, ENTRY_BYTES = 128 * 1024 * 1024, 14
# Numbers of documents that one task of a pass has at once.
STATE_BYTES = 32 * 1024 * 1024
# Curvature that a document adds along an intercept, as far as it exceeds that of common terms.
INTERCEPT_CURVATURE = 0.005


@dataclass(frozen=True)
class Loss:
    """A convex loss over blocks of documents: margins ``z[document, class]``, true classes ``y`` and a factor per class.

    ``value`` is the block's sum, ``slopes`` the derivative by every margin, ``curved`` the change of the slopes
    with a change ``dz`` of the margins, to first order.
    """

    name: str
    value: Callable[[np.ndarray, np.ndarray, np.ndarray], float]
    slopes: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    curved: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    intercept_penalty: bool
    has_probability: bool


def _log_loss(z: np.ndarray, y: np.ndarray, factors: np.ndarray) -> float:
    top = z.max(axis=1)
    total = np.log(np.exp(z - top[:, None]).sum(axis=1)) + top
    return float(factors[y] @ (total - z[np.arange(len(y)), y]))


def _log_slopes(z: np.ndarray, y: np.ndarray, factors: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    return p * factors[y][:, None]


def _log_curved(z: np.ndarray, y: np.ndarray, factors: np.ndarray, dz: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return factors[y][:, None] * p * (dz - (p * dz).sum(axis=1, keepdims=True))


def _sides(z: np.ndarray, y: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Side of every class, how far the margin falls short of it, and its factor."""
    own = np.arange(z.shape[1])[None, :] == y[:, None]
    side = np.where(own, 1.0, -1.0)
    return side, np.maximum(0, 1 - side * z), np.where(own, factors[None, :], 1.0)


def _hinge_loss(z: np.ndarray, y: np.ndarray, factors: np.ndarray) -> float:
    _, short, factor = _sides(z, y, factors)
    return float((factor * short * short).sum())


def _hinge_slopes(z: np.ndarray, y: np.ndarray, factors: np.ndarray) -> np.ndarray:
    side, short, factor = _sides(z, y, factors)
    return -2 * factor * side * short


def _hinge_curved(z: np.ndarray, y: np.ndarray, factors: np.ndarray, dz: np.ndarray) -> np.ndarray:
    _, short, factor = _sides(z, y, factors)
    return 2 * factor * (short > 0) * dz


LOGISTIC_LOSS = Loss("logistic", _log_loss, _log_slopes, _log_curved, intercept_penalty=False, has_probability=True)
# One class against the rest, all classes side by side; a class's factor counts on its positive side.
SQUARED_HINGE = Loss("squared hinge", _hinge_loss, _hinge_slopes, _hinge_curved, intercept_penalty=True, has_probability=False)


def _block(batch: pa.RecordBatch, column: str, k: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k)


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(np.ascontiguousarray(rows).ravel()))


def residuals(documents: DataFrame, loss: Loss, factors: list[float]) -> DataFrame:
    """``(_doc, r)`` out of ``documents(_doc, y, z)``: the slopes of the loss at the margins."""
    weights = np.array(factors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            r = loss.slopes(_block(batch, "z", len(weights)), y, weights)
            yield pa.RecordBatch.from_arrays([batch.column(DOC), _lists(r)], [DOC, "r"])

    return documents.select(DOC, "y", "z").mapInArrow(run, f"{DOC} long, r array<double>")


def along(state: DataFrame, loss: Loss, factors: list[float], lengths: list[float], d: np.ndarray, own_d: np.ndarray) -> np.ndarray:
    """For each step length from chunks ``state(y, z, u)`` in direction ``d``: the summed loss, and the summed slopes by class,
    which are the gradient by the intercepts."""
    weights = np.array(factors)
    k = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(lengths), 1 + k))
        for batch in batches:
            for row in batch.to_pylist():
                y, z = np.frombuffer(row["y"], np.int32), np.frombuffer(row["z"]).reshape(-1, k)
                dz = np.einsum("b,bnk->nk", d, np.frombuffer(row["u"]).reshape(len(d), -1, k)) + own_d
                for i, length in enumerate(lengths):
                    at = z + length * dz
                    total[i, 0] += loss.value(at, y, weights)
                    total[i, 1:] += loss.slopes(at, y, weights).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["at", "x"])

    return _summed(state.select("y", "z", "u").mapInArrow(run, "at int, x double"), (len(lengths), 1 + k))


def _summed(partial: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sums of ``(at, x)`` as a table of a fixed size."""
    out = np.zeros(shape[0] * shape[1])
    for row in partial.groupBy("at").agg(F.sum("x").alias("x")).collect():  # lengths x classes, or vectors x vectors
        out[row.at] = row.x
    return out.reshape(shape)


def combination(products: np.ndarray, memory: int) -> np.ndarray:
    """Factors of the L-BFGS direction over ``[steps, differences, gradient, weights]``, from their inner products.

    Steps and differences are the last ``memory``, the oldest first. Pairs that were never filled
    are zero and are passed over.
    """
    m = memory
    factors = np.zeros(2 * m + 2)
    factors[2 * m] = -1.0
    used = [i for i in range(m) if products[i, m + i] > 0]
    alphas = {}
    for i in reversed(used):
        alphas[i] = factors @ products[:, i] / products[i, m + i]
        factors[m + i] -= alphas[i]
    if used:
        last = used[-1]
        factors *= products[last, m + last] / products[m + last, m + last]
    for i in used:
        beta = factors @ products[:, m + i] / products[i, m + i]
        factors[i] += alphas[i] - beta
    return factors


class TermPartitionedSet:
    """Training features stored in cells for training, and by term and by document for single sums; each when first asked for.

    Documents are numbered, so ids may repeat or be missing. A term's rows by term are spread by document
    over ``salts`` buckets, so that a term of all documents is no single task's work. ``close`` drops the
    registered tables; cells stay stored and are registered again when training asks for them.
    """

    def __init__(
        self, train: DataFrame, config: TfidfConfig = TfidfConfig(), columns: Columns = DEFAULT_COLUMNS,
        tfidf: TfidfModel | None = None, buckets: int | None = None, salts: int = SALTS,
    ):
        self.spark = train.sparkSession
        self.columns = columns
        self.tfidf = tfidf or fit_tfidf(train, config, columns)
        self.counts = class_counts(train, columns)
        self.labels = [label for label, _ in self.counts]
        self.n_rows = sum(n for _, n in self.counts)
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.given_buckets = buckets
        self.salts = salts
        self.tables: list[str] = []
        self._numbered = materialise(train.select(columns.label, content_column(train, columns)).withColumn(DOC, F.monotonically_increasing_id()), "numbered")
        index = F.create_map(*[F.lit(x) for i, label in enumerate(self.labels) for x in (label, i)])
        self.documents = self._numbered.select(DOC, F.element_at(index, F.col(columns.label)).alias("y"))

    @cached_property
    def _rows(self) -> DataFrame:
        by_number = replace(self.tfidf, columns=replace(self.columns, id=DOC))
        salt = F.pmod(F.xxhash64(DOC), F.lit(self.salts)).cast("int")
        return materialise(by_number.transform(self._numbered).select(DOC, "term", F.col("tfidf").alias("x"), salt.alias(SALT)), "features")

    @cached_property
    def by_term(self) -> DataFrame:
        return self.spark.table(self.bucketed(self._rows, ["term", SALT])[0])

    @cached_property
    def by_document(self) -> DataFrame:
        return self.spark.table(self.bucketed(self._rows.drop(SALT), [DOC])[0])

    def bucketed(self, rows: DataFrame, keys: list[str], placed: bool = False, buckets: int | None = None) -> tuple[str, str]:
        """The name and the folder of the stored table. Rows that a join by ``keys`` left ``placed`` are not moved again."""
        buckets = buckets or self.buckets
        name, path = f"textloom_features_{uuid.uuid4().hex}", new_path(self.spark, "features")
        writer = (rows if placed else rows.repartition(buckets, *keys)).write.format("parquet")
        writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
        self.tables.append(name)
        return name, path

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.remove(name)

    def close(self) -> None:
        for name in list(self.tables):
            self.drop(name)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return materialise(self.tfidf.indexed_vocabulary().select("term", "df", "idf", "idx"), "vocabulary")

    @cached_property
    def entries(self) -> int:
        return self.vocabulary.agg(F.sum("df")).first()[0] or 0

    @cached_property
    def wanted_parts(self) -> int:
        """As many for every task that trains."""
        tasks = tasks_for(self.spark, self.entries)
        return tasks * math.ceil(max(1, self.entries * ENTRY_BYTES / PART_BYTES) / tasks)

    @cached_property
    def pass_buckets(self) -> int:
        """Buckets of cells and of the documents' numbers: a pass is short, so there are no more than cores, unless the parts
        or what a task would hold ask for them."""
        numbers = self.n_rows * len(self.labels) * 8 * (2 * WIDTH + 1)
        cores = self.spark.sparkContext.defaultParallelism
        return self.given_buckets or max(cores, self.wanted_parts, math.ceil(numbers / STATE_BYTES))

    @cached_property
    def parts(self) -> list[int]:
        """A key for every part of the terms, each in a bucket of its own."""
        wanted = min(self.pass_buckets, self.wanted_parts)
        key, at = F.col("id").cast("int"), F.lit(self.pass_buckets)
        keys = self.spark.range(16 * self.pass_buckets).groupBy(F.pmod(F.hash(key), at).alias("at")).agg(F.min(key).alias("key"))
        return [r.key for r in keys.orderBy("at").limit(wanted).collect()]

    @cached_property
    def _cells(self) -> tuple[str, str]:
        parts, mask = np.array(self.parts, dtype=np.int32), (1 << CHUNK_BITS) - 1
        names = [CHUNK, PART, "at", "term", "x"]

        def cut(key: tuple, rows: pa.Table) -> pa.Table:
            at = rows.column(DOC).to_numpy() & mask
            idx, raw = rows.column("idx").to_numpy(), rows.column("raw").to_numpy()
            x = raw / np.sqrt(np.bincount(at, raw * raw))[at]
            order = np.argsort(idx % len(parts), kind="stable")
            ends = np.searchsorted((idx % len(parts))[order], np.arange(len(parts) + 1))
            out = []
            for p in range(len(parts)):
                own = order[ends[p] : ends[p + 1]]
                if len(own):
                    out.append((at[own].astype(np.uint16).tobytes(), (idx[own] // len(parts)).astype(np.int32).tobytes(), x[own].tobytes(), parts[p]))
            columns = [pa.array([r[i] for r in out], pa.binary()) for i in range(3)]
            keys = [pa.array([key[0].as_py()] * len(out), pa.int64()), pa.array([r[3] for r in out], pa.int32())]
            return pa.Table.from_arrays([*keys, *columns], names)

        numbered = replace(self.columns, id=DOC)
        known = known_rows(self._numbered, self.vocabulary.select("term", "idf", "idx"), self.tfidf.config, numbered)
        rows = known.select(DOC, F.col("idx").cast("long").alias("idx"), (self.tfidf.config.term_weight() * F.col("idf")).alias("raw"))
        schema = f"{CHUNK} long, {PART} int, at binary, term binary, x binary"
        cells = rows.groupBy(F.shiftright(DOC, CHUNK_BITS).alias(CHUNK)).applyInArrow(cut, schema)
        name, path = self.bucketed(cells, [PART], buckets=self.pass_buckets)
        self.drop(name)
        return schema, path

    def cells(self) -> DataFrame:
        """``(_chunk, _part, at, term, x)``: a chunk's features of a part's terms, as packed positions of documents in the chunk
        and of terms in the part, and values."""
        schema, path = self._cells
        name = f"textloom_features_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (path '{path}') CLUSTERED BY ({PART}) SORTED BY ({PART}) INTO {self.pass_buckets} BUCKETS"
        )
        self.tables.append(name)
        return self.spark.table(name)

    def multiplied(self, factors: DataFrame, cells: DataFrame, back: bool) -> DataFrame:
        """Out of chunks ``factors(_chunk, a)``: ``X' a`` as ``(idx, weights)``, or with ``back`` ``X X' a`` as ``(_chunk, u)``, in parts that add up."""
        parts, k, n_terms = self.parts, len(self.labels), self.tfidf.n_terms

        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            p = parts.index(key[0].as_py())
            a = {r[CHUNK]: np.frombuffer(r["a"]).reshape(-1, k) for r in left.select([CHUNK, "a"]).to_pylist()}
            sums = np.zeros((k, len(range(p, n_terms, len(parts)))))

            def read() -> Iterator[tuple]:
                for i in range(right.num_rows):
                    at, term, x = (right.column(c)[i].as_buffer() for c in ("at", "term", "x"))
                    yield right.column(CHUNK)[i].as_py(), np.frombuffer(at, np.uint16), np.frombuffer(term, np.int32), np.frombuffer(x)

            for chunk, at, term, x in read():
                for j in range(k):
                    np.add.at(sums[j], term, x * a[chunk][at, j])
            if not back:
                idx = np.arange(p, n_terms, len(parts))
                return pa.Table.from_arrays([pa.array(idx), _lists(sums.T)], ["idx", "weights"])
            chunks, out = [], []
            for chunk, at, term, x in read():
                u = [np.bincount(at, x * sums[j][term], len(a[chunk])) for j in range(k)]
                chunks.append(chunk)
                out.append(np.stack(u, axis=1).tobytes())
            return pa.Table.from_arrays([pa.array(chunks, pa.int64()), pa.array(out, pa.binary())], [CHUNK, "u"])

        copies = factors.withColumn(PART, F.explode(F.array(*[F.lit(key) for key in parts])))
        schema = f"{CHUNK} long, u binary" if back else "idx long, weights array<double>"
        return copies.groupBy(PART).cogroup(cells.groupBy(PART)).applyInArrow(run, schema)

    def balanced(self) -> list[float]:
        return [self.n_rows / (len(self.labels) * n) for _, n in self.counts]

    def margins(self, terms: DataFrame, weights: str) -> DataFrame:
        """``(_doc, sums)`` of ``terms(term, <weights>)`` for documents with known terms; intercepts are not in them."""
        salted = terms.select("term", F.col(weights).alias("_w"), F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))).alias(SALT))
        sums = [F.sum(F.col("x") * F.get("_w", F.lit(k))) for k in range(len(self.labels))]
        return self.by_term.join(salted, ["term", SALT]).groupBy(DOC).agg(F.array(*sums).alias("sums"))

    def gradient(self, residuals: DataFrame) -> DataFrame:
        """``(term, gradient)`` out of ``residuals(_doc, r)``: sums over the documents that have the term."""
        sums = [F.sum(F.col("x") * F.get("r", F.lit(k))) for k in range(len(self.labels))]
        return self.by_document.join(residuals, DOC).groupBy("term").agg(F.array(*sums).alias("gradient"))


def loss_gradient(data: TermPartitionedSet, terms: DataFrame, intercepts: list[float], loss: Loss, factors: list[float]) -> DataFrame:
    """``(term, gradient)`` of the summed loss, without its penalty, at ``terms(term, weights)``."""
    zeros = F.array(*[F.lit(0.0)] * len(intercepts))
    known = data.documents.join(data.margins(terms, "weights"), DOC, "left")
    z = F.zip_with(F.coalesce("sums", zeros), F.array(*[F.lit(float(b)) for b in intercepts]), lambda a, b: a + b)
    return data.gradient(residuals(known.withColumn("z", z), loss, factors))


# Vectors kept per document: the Newton step so far, the direction of its search, what the step leaves of the gradient,
# the curvature along the direction, and the weights.
STEP, ALONG, LEFT, CURVED, WEIGHTS = range(WIDTH := 5)


@dataclass(frozen=True)
class Change:
    """What a pass does to the vectors: ``mix`` makes the new ones out of the old, margins move by ``shift`` of the old vectors
    and ``own`` by class. It then takes the curvature along ``ALONG``, whose intercepts add ``own_along``, to the features, or
    without that the slopes of the loss."""

    mix: np.ndarray
    shift: np.ndarray
    own: np.ndarray
    own_along: np.ndarray | None = None


def fit_term_partitioned(
    data: TermPartitionedSet, name: str, loss: Loss = LOGISTIC_LOSS, balanced: bool = False, c: float = 1.0,
    max_iter: int = 200, tol: float = 5e-5,
) -> TextClassifier:
    """Minimise ``0.5 * |w|^2 + c * sum(weight * loss)`` to within ``tol`` of the optimal weights.

    The penalty makes the objective strongly convex, so the length of its gradient bounds the distance to the
    optimum; training stops when that bound is ``tol``, or when no step length makes the objective smaller. ``max_iter``
    bounds the Newton steps.
    """
    k = len(data.labels)
    factors = data.balanced() if balanced else [1.0] * k
    by_class = np.array(factors)
    # Per chunk: classes, margins, the factors and the margins of all vectors, and sums over the chunk.
    schema = f"{CHUNK} long, y binary, z binary, a binary, u binary, p binary"
    names = [CHUNK, "y", "z", "a", "u", "p"]

    def after(row: dict, change: Change) -> tuple[np.ndarray, ...]:
        """Classes, margins and vectors after the change, and the factors to be taken to the features."""
        y, z = np.frombuffer(row["y"], np.int32), np.frombuffer(row["z"]).reshape(-1, k)
        a, u = (np.frombuffer(row[c]).reshape(WIDTH, -1, k) for c in ("a", "u"))
        z = z + np.tensordot(change.shift, u, 1) + change.own
        a, u = (np.tensordot(change.mix, v, 1) for v in (a, u))
        if change.own_along is None:
            return y, z, a, u, c * loss.slopes(z, y, by_class)
        return y, z, a, u, c * loss.curved(z, y, by_class, u[ALONG] + change.own_along)

    def taken(change: Change):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    a = after(row, change)[-1].tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([row[CHUNK]], pa.int64()), pa.array([a], pa.binary())], [CHUNK, "a"])

        return run

    def changed(change: Change):
        """The next state, with what came back from the features."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            y, z, a, u, new = after(row, change)
            back = sum((np.frombuffer(r["u"]) for r in right.to_pylist()), np.zeros(new.size)).reshape(new.shape)
            if change.own_along is None:  # the gradient is the weights and the slopes
                a[LEFT], u[LEFT] = -(a[WEIGHTS] + new), -(u[WEIGHTS] + back)
                a[ALONG], u[ALONG] = a[LEFT], u[LEFT]
            else:
                a[CURVED], u[CURVED] = new, back
            products = a.reshape(WIDTH, -1) @ u.reshape(WIDTH, -1).T
            sums = np.concatenate([products.ravel(), [loss.value(z, y, by_class)], new.sum(axis=0)])
            packed = [row["y"], z.tobytes(), a.tobytes(), u.tobytes(), sums.tobytes()]
            return pa.Table.from_arrays([pa.array([row[CHUNK]], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]], names)

        return run

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH * WIDTH + 1 + k)
        for batch in batches:
            for row in batch.to_pylist():
                total += np.frombuffer(row["p"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total)], ["at", "x"])

    def started(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column(DOC).to_numpy())
        y = rows.column("y").to_numpy()[order].astype(np.int32)
        zeros = [np.zeros((size, len(y), k)).tobytes() for size in (1, WIDTH, WIDTH)]
        packed = [y.tobytes(), *zeros, np.zeros(WIDTH * WIDTH + 1 + k).tobytes()]
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]], names)

    stored: list[tuple[str, str]] = []

    def leave(n: int) -> None:
        """Only the last ``n`` states stay stored."""
        for name, path in stored[: len(stored) - n]:
            data.drop(name)
            delete_folder(data.spark, path)
        del stored[: len(stored) - n]

    def kept(state: DataFrame) -> DataFrame:
        """The state as a stored table. Two before stay too, as a step may have to be taken back and tried again."""
        stored.append(data.bucketed(state, [CHUNK], placed=bool(stored), buckets=data.pass_buckets))
        leave(3)
        return data.spark.table(stored[-1][0])

    def moved(state: DataFrame, change: Change) -> tuple[DataFrame, np.ndarray, float, np.ndarray]:
        """The next state, the inner products of its vectors without the intercepts' part, the summed loss, and the sums by
        class of the factors that were taken to the features."""
        taken_along = state.select(*names[:-1]).mapInArrow(taken(change), f"{CHUNK} long, a binary")
        margins = data.multiplied(taken_along, cells, back=True)
        state = kept(state.groupBy(CHUNK).cogroup(margins.groupBy(CHUNK)).applyInArrow(changed(change), schema))
        sums = _summed(state.select("p").mapInArrow(added, "at int, x double"), (1, WIDTH * WIDTH + 1 + k))[0]
        products = sums[: WIDTH * WIDTH].reshape(WIDTH, WIDTH)
        return state, (products + products.T) / 2, sums[WIDTH * WIDTH], sums[WIDTH * WIDTH + 1 :]

    # The intercepts' parts of the vectors are in units of ``unit``: the loss curves with the number of
    # documents along an intercept, which every document has, and far less along any term.
    unit = (1 + INTERCEPT_CURVATURE * c * data.n_rows) ** -0.5
    penalty = unit * unit if loss.intercept_penalty else 0.0
    own = np.zeros(k)  # of the weights
    none = np.zeros(WIDTH)
    state = kept(data.documents.groupBy(F.shiftright(DOC, CHUNK_BITS).alias(CHUNK)).applyInArrow(started, schema))

    def classifier(weights: DataFrame, intercepts: np.ndarray) -> TextClassifier:
        terms = materialise(data.vocabulary.join(weights, "idx").select("term", "df", "idf", "weights"), "weights")
        leave(0)
        return TextClassifier(
            name=name, labels=data.labels, intercepts=intercepts.tolist(),
            terms=terms,
            n_terms=data.tfidf.n_terms, n_docs=data.tfidf.n_docs, has_probability=loss.has_probability,
            config=data.tfidf.config, columns=data.columns,
            hyperparameters={
                "loss": loss.name, "C": str(c), "max_iter": str(max_iter), "class_weight": "balanced" if balanced else "none", "tol": str(tol),
            },
        )

    if runs_together(data.spark, stored[0][1]):
        def problem(folder: str) -> Problem:
            return Problem(
                data._cells[1], stored[0][1], folder, data.parts, data.tfidf.n_terms, factors, loss, c, max_iter, tol, unit,
                min(tasks_for(data.spark, data.entries), len(data.parts)),
            )

        rows = trained(data.spark, problem, CHUNK, PART, lambda rows: materialise(rows, "trained"))
        last_rows = rows.filter("idx < 0").select("idx", F.get("weights", F.lit(0)).alias("x")).collect()  # one per class
        return classifier(rows.filter("idx >= 0"), np.array([r.x for r in sorted(last_rows, key=lambda r: -r.idx)]))

    cells = data.cells()

    def gradient(state: DataFrame, length: float, last: float, own_step: np.ndarray):
        """The state after ``length`` of the step, which is ``STEP`` and ``last`` of ``ALONG``: with products, objective, the
        intercepts' part of the gradient, and the gradient's length."""
        mix, shift = np.zeros((WIDTH, WIDTH)), none.copy()
        shift[STEP], shift[ALONG] = length, length * last
        mix[WEIGHTS] = shift
        mix[WEIGHTS, WEIGHTS] = 1.0
        state, products, value, sums = moved(state, Change(mix, shift, length * unit * own_step))
        at = own + length * own_step
        own_gradient = unit * sums + penalty * at
        value = c * value + 0.5 * (products[WEIGHTS, WEIGHTS] + penalty * at @ at)
        return state, products, value, own_gradient, math.sqrt(products[LEFT, LEFT] + np.sum((own_gradient / unit) ** 2))

    state, products, value, own_gradient, norm = gradient(state, 0.0, 0.0, own)
    first = norm
    for _ in range(max_iter):
        if norm <= tol:
            break
        enough = max(min(0.5, math.sqrt(norm / first)) * norm, tol / 4)
        own_step, own_along, own_left = np.zeros(k), -own_gradient, -own_gradient
        mix = np.eye(WIDTH)
        for _ in range(MAX_PRODUCTS):
            state, products, _, sums = moved(state, Change(mix, none, np.zeros(k), unit * own_along))
            own_curved = unit * sums + penalty * own_along
            left = products[LEFT, LEFT] + own_left @ own_left
            last = left / (products[ALONG, ALONG] + products[ALONG, CURVED] + own_along @ own_curved)
            own_step = own_step + last * own_along
            own_left = own_left - last * own_curved
            crossed = products[LEFT, ALONG] + products[LEFT, CURVED]
            squared = products[ALONG, ALONG] + 2 * products[ALONG, CURVED] + products[CURVED, CURVED]
            rest = max(0.0, products[LEFT, LEFT] - 2 * last * crossed + last * last * squared)
            if math.sqrt(rest + np.sum((own_left / unit) ** 2)) <= enough:
                break
            again = (rest + own_left @ own_left) / left
            own_along = own_left + again * own_along
            mix = np.eye(WIDTH)
            mix[STEP, ALONG] = last
            mix[LEFT, ALONG] = mix[LEFT, CURVED] = -last
            mix[ALONG] = mix[LEFT]
            mix[ALONG, ALONG] += again
            mix[CURVED] = 0.0
        before = state
        d = none.copy()
        d[STEP], d[ALONG] = 1.0, last
        w_w, w_d = products[WEIGHTS, WEIGHTS] + penalty * own @ own, products[WEIGHTS] @ d + penalty * own @ own_step
        d_d = d @ products @ d + penalty * own_step @ own_step
        length = 1.0
        state, products, now, own_gradient, new_norm = gradient(before, length, last, own_step)
        # Close to the optimum the objective's digits do not tell; the gradient does.
        if now >= value and new_norm >= norm:
            lengths = [0.0, *LENGTHS]
            tried = along(before, loss, factors, lengths, d, unit * own_step)[:, 0]
            values = [c * tried[i] + 0.5 * (w_w + 2 * x * w_d + x * x * d_d) for i, x in enumerate(lengths)]
            length = lengths[int(np.argmin(values))]
            state, products, now, own_gradient, new_norm = gradient(before, length, last, own_step)
        own, value, norm = own + length * own_step, now, new_norm
        if not length:
            break

    def weights_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = np.frombuffer(row["a"]).reshape(WIDTH, -1)[WEIGHTS].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([row[CHUNK]], pa.int64()), pa.array([a], pa.binary())], [CHUNK, "a"])

    weights = data.multiplied(state.select(CHUNK, "a").mapInArrow(weights_of, f"{CHUNK} long, a binary"), cells, back=False)
    return classifier(weights, unit * own)
