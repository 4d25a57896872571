"""Newton's steps for linear models inside one stage, whose tasks run side by side and keep what they hold.

A task owns parts of the terms, with their features and every vector's numbers by term, and a slice of the documents,
with their margins. A product with the curvature takes two exchanges: every task writes what its terms add to the
margins of all documents, and its slice's factors. Both go through files in the shared folder, a number per document and
class, and so do sums of a few numbers. A pass needs no Spark job, and no vector of the vocabulary comes together anywhere.

Features are read from the stored cells once and lie in an unnamed file on the task's own disk that is mapped into memory, a
few arrays per cell. A lost task fails the stage, which starts again from the cells in a folder of its own.
"""

from __future__ import annotations

import math
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession

from textloom.storage import delete_folder, new_path

# Features that are worth a task of their own.
TASK_ENTRIES = 200_000
# Step lengths tried at once where a whole Newton step does not help.
LENGTHS = [2.0**-e for e in range(1, 31)]
# Products with the curvature that one Newton step may take.
MAX_PRODUCTS = 500
# Rows of cells read at a time.
READ_ROWS = 16


def runs_together(spark: SparkSession, folder: str) -> bool:
    """Whether all tasks of a stage can run at once and reach the shared folder by themselves."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return False
    try:
        fs.FileSystem.from_uri(folder)
    except (pa.ArrowException, OSError):
        return False
    return True


def tasks_for(spark: SparkSession, entries: int) -> int:
    return max(1, min(spark.sparkContext.defaultParallelism, math.ceil(entries / TASK_ENTRIES)))


@dataclass(frozen=True)
class Problem:
    """What all tasks know: where cells and classes are stored, the parts of the terms, and what is minimised."""

    cells: str
    classes: str
    folder: str
    parts: list[int]
    n_terms: int
    factors: list[float]
    loss: object
    c: float
    max_iter: int
    tol: float
    unit: float
    tasks: int


class Exchange:
    """What the tasks of the stage tell each other: round by round a file of every task, which all the others read."""

    def __init__(self, folder: str):
        context = BarrierTaskContext.get()
        self.rank, self.tasks, self.round = context.partitionId(), len(context.getTaskInfos()), 0
        self.store, path = fs.FileSystem.from_uri(folder)
        # Another name each time that the stage starts. Spark's own exchange takes a second, so there is just this one.
        self.folder = f"{path}/{context.allGather(uuid.uuid4().hex)[0]}"
        self.store.create_dir(self.folder, recursive=True)

    def _path(self, number: int, rank: int) -> str:
        return f"{self.folder}/{number}-{rank}"

    def write(self, *blocks: np.ndarray) -> None:
        self.write_all(iter(blocks))

    def write_all(self, blocks: Iterator[np.ndarray]) -> None:
        """The next round begins with this task's numbers. Who writes has read the round before, so all have read the one before that."""
        self.round += 1
        path = self._path(self.round, self.rank)
        with self.store.open_output_stream(f"{path}.part") as out:
            for block in blocks:
                out.write(pa.py_buffer(np.ascontiguousarray(block, dtype=np.float64)))
        self.store.move(f"{path}.part", path)
        if self.round > 2:
            self.store.delete_file(self._path(self.round - 2, self.rank))

    def read(self, rank: int, offset: int, n: int) -> np.ndarray:
        """Numbers of another task's file of this round, as soon as it is there."""
        wait = 0.001
        while True:
            try:
                with self.store.open_input_file(self._path(self.round, rank)) as file:
                    return np.frombuffer(file.read_at(n * 8, offset * 8))
            except FileNotFoundError:
                time.sleep(wait)
                wait = min(0.05, wait * 1.5)

    def total(self, numbers: list) -> np.ndarray:
        """Sums over all tasks, the same in each of them."""
        self.write(np.array(numbers, dtype=np.float64))
        return np.sum([self.read(r, 0, len(numbers)) for r in range(self.tasks)], axis=0)


def _rows(folder: str, columns: list[str], key: str | None = None, wanted: set[int] | None = None) -> Iterator[dict]:
    """Rows of a stored table, of those row groups that can hold a wanted key."""
    store, path = fs.FileSystem.from_uri(folder)
    files = [f.path for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.base_name.endswith(".parquet")]
    for name in sorted(files):
        with store.open_input_file(name) as file, pq.ParquetFile(file) as table:
            groups = list(range(table.num_row_groups))
            if key:
                at = table.schema_arrow.get_field_index(key)
                bounds = [table.metadata.row_group(g).column(at).statistics for g in groups]
                groups = [g for g, b in zip(groups, bounds, strict=True) if b is None or not b.has_min_max or any(b.min <= w <= b.max for w in wanted)]
            for batch in table.iter_batches(READ_ROWS, row_groups=groups, columns=columns, use_threads=False) if groups else ():
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in columns}
                    if not key or row[key].as_py() in wanted:
                        yield row


class Features:
    """A task's cells: for each its chunk, the terms it has, and per feature the document, the term's place among those, and the value."""

    def __init__(self, problem: Problem, rank: int, chunk: str, part: str):
        n, self.cells = len(problem.parts), []
        own = {problem.parts[p]: p for p in range(rank, n, problem.tasks)}
        sizes = {key: len(range(p, problem.n_terms, n)) for key, p in own.items()}
        starts, at = {}, 0
        for key, size in sizes.items():
            starts[key], at = at, at + size
        self.n_terms, self.idx = at, [np.arange(p, problem.n_terms, n) for p in own.values()]
        held, end = tempfile.TemporaryFile(), 0
        found = []
        for row in _rows(problem.cells, [chunk, part, "at", "term", "x"], part, set(own)):
            rows, term, x = (np.frombuffer(row[c].as_buffer(), kind) for c, kind in (("at", np.uint16), ("term", np.int32), ("x", np.float64)))
            terms, place = np.unique(term, return_inverse=True)
            arrays = [x, place.astype(np.int32), (terms + starts[row[part].as_py()]).astype(np.int32), rows]
            found.append((row[chunk].as_py(), end, [len(a) for a in arrays]))
            for a in arrays:
                held.write(a.tobytes())
                end += a.nbytes
            end += held.write(b"\0" * (-end % 8))
        held.flush()
        self.map = np.memmap(held, np.uint8, "r", shape=(end,)) if end else np.zeros(0, np.uint8)
        held.close()  # the mapping keeps it
        for number, at, lengths in found:
            arrays = []
            for kind, length in zip((np.float64, np.int32, np.int32, np.uint16), lengths, strict=True):
                to = at + length * np.dtype(kind).itemsize
                arrays.append(self.map[at:to].view(kind))
                at = to
            self.cells.append((number, *arrays))


def train(problem: Problem, chunk: str, part: str) -> Iterator[pa.RecordBatch]:
    """The weights of the task's terms as ``(idx, weights)``; the first task adds the intercepts, class ``i`` under ``-1 - i``."""
    tell = Exchange(problem.folder)
    rank, k, c, loss = tell.rank, len(problem.factors), problem.c, problem.loss
    by_class, unit = np.array(problem.factors), problem.unit
    penalty = unit * unit if loss.intercept_penalty else 0.0

    # Documents are cut into a slice per task at the borders of chunks.
    classes = {r[chunk].as_py(): np.frombuffer(r["y"].as_buffer(), np.int32) for r in _rows(problem.classes, [chunk, "y"])}
    order = sorted(classes)
    lengths = np.array([len(classes[x]) for x in order], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    slices = np.minimum(starts * tell.tasks // max(1, lengths.sum()), tell.tasks - 1)
    sizes = np.bincount(slices, lengths, tell.tasks).astype(np.int64)
    offsets = np.cumsum(sizes) - sizes
    place = {x: (int(s), int(at - offsets[s]), int(n)) for x, s, at, n in zip(order, slices, starts, lengths, strict=True)}
    y = np.concatenate([np.zeros(0, np.int32), *[classes[x] for x, s in zip(order, slices, strict=True) if s == rank]])
    del classes
    features = Features(problem, rank, chunk, part)
    by_slice: list[list[tuple]] = [[] for _ in range(tell.tasks)]
    for number, *arrays in features.cells:
        s, at, n = place[number]
        by_slice[s].append((at, n, *arrays))

    def to_documents(v: np.ndarray) -> np.ndarray:
        """The slice's rows of ``X v``."""

        def blocks() -> Iterator[np.ndarray]:
            for s, cells in enumerate(by_slice):
                out = np.zeros((k, sizes[s]))
                for at, n, x, place, terms, rows in cells:
                    place, rows = place.astype(np.intp), rows.astype(np.intp)  # once, not for every class
                    for j in range(k):
                        out[j, at : at + n] += np.bincount(rows, x * v[j][terms][place], n)
                yield out

        tell.write_all(blocks())
        out = np.zeros(k * sizes[rank])
        for other in range(tell.tasks):
            out += tell.read(other, k * offsets[rank], out.size)
        return out.reshape(k, -1).T

    def to_terms(a: np.ndarray, numbers: list, squared: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The part's rows of ``X' a`` out of the slices of ``a``, or with the features squared, and the sums of ``numbers``."""
        tell.write(np.array(numbers), a.T)
        out, sums = np.zeros((k, features.n_terms)), np.zeros(len(numbers))
        for s, cells in enumerate(by_slice):
            block = tell.read(s, 0, len(numbers) + k * int(sizes[s]))
            sums, block = sums + block[: len(numbers)], block[len(numbers) :].reshape(k, -1)
            for at, n, x, place, terms, rows in cells:
                place, rows, some = place.astype(np.intp), rows.astype(np.intp), x * x if squared else x
                for j in range(k):
                    out[j][terms] += np.bincount(place, some * block[j, at : at + n][rows], len(terms))
        return out, sums

    def gradient(w: np.ndarray, z: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        """By terms and by intercepts, the objective, and the gradient's length."""
        slopes = c * loss.slopes(z, y, by_class)
        back, sums = to_terms(slopes, [loss.value(z, y, by_class), *slopes.sum(axis=0)])
        g, own_g = w + back, unit * sums[1:] + penalty * own
        squares = tell.total([np.sum(w * w), np.sum(g * g)])
        value = c * sums[0] + 0.5 * (squares[0] + penalty * own @ own)
        return g, own_g, value, math.sqrt(squares[1] + np.sum((own_g / unit) ** 2))

    w, own, z = np.zeros((k, features.n_terms)), np.zeros(k), np.zeros((len(y), k))
    g, own_g, value, norm = gradient(w, z, own)
    first = norm
    for _ in range(problem.max_iter):
        if norm <= problem.tol:
            break
        enough = max(min(0.5, math.sqrt(norm / first)) * norm, problem.tol / 4)
        # Conjugate gradients, each coefficient in units of its own curvature.
        own_curve = np.stack([loss.curved(z, y, by_class, np.broadcast_to(e, z.shape))[:, j] for j, e in enumerate(np.eye(k))], axis=1)
        scale, sums = to_terms(c * own_curve, c * own_curve.sum(axis=0), squared=True)
        scale += 1
        own_scale = unit * unit * sums + penalty
        own_scale = np.where(own_scale > 0, own_scale, 1.0)
        if not loss.intercept_penalty:  # of one scale they keep their sum, which no slope determines
            own_scale[:] = own_scale.mean()
        left, own_left = -g, -own_g
        along, own_along = left / scale, own_left / own_scale
        last = tell.total([np.sum(left * along)])[0] + own_left @ own_along
        step, own_step, moved = np.zeros_like(w), np.zeros(k), np.zeros_like(z)
        for _ in range(MAX_PRODUCTS):
            u = to_documents(along)
            curved = c * loss.curved(z, y, by_class, u + unit * own_along)
            back, sums = to_terms(curved, [np.sum(along * along), np.sum(u * curved), *curved.sum(axis=0)])
            own_back = unit * sums[2:] + penalty * own_along
            length = last / (sums[0] + sums[1] + own_along @ own_back)
            step += length * along
            own_step = own_step + length * own_along
            moved += length * u
            left = left - length * (along + back)
            own_left = own_left - length * own_back
            towards, own_towards = left / scale, own_left / own_scale
            rest, now = tell.total([np.sum(left * left), np.sum(left * towards)])
            if math.sqrt(rest + np.sum((own_left / unit) ** 2)) <= enough:
                break
            now += own_left @ own_towards
            along, own_along = towards + now / last * along, own_towards + now / last * own_along
            last = now
        moved += unit * own_step
        found = gradient(w + step, z + moved, own + own_step)
        length = 1.0
        # Close to the optimum the objective's digits do not tell; the gradient does.
        if found[2] >= value and found[3] >= norm:
            lengths = [0.0, *LENGTHS]
            mine = [c * loss.value(z + x * moved, y, by_class) + 0.5 * np.sum((w + x * step) ** 2) for x in lengths]
            values = tell.total(mine) + [0.5 * penalty * np.sum((own + x * own_step) ** 2) for x in lengths]
            length = lengths[int(np.argmin(values))]
            found = gradient(w + length * step, z + length * moved, own + length * own_step)
        w, z, own = w + length * step, z + length * moved, own + length * own_step
        g, own_g, value, norm = found
        if not length:
            break

    at = 0
    for idx in features.idx:
        yield _weights(idx, w[:, at : at + len(idx)].T)
        at += len(idx)
    if not rank:
        yield _weights(-1 - np.arange(k), unit * own[:, None])


def _weights(idx: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    n, k = rows.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(np.ascontiguousarray(rows).ravel()))
    return pa.RecordBatch.from_arrays([pa.array(idx, pa.int64()), lists], ["idx", "weights"])


def trained(spark: SparkSession, problem: Callable[[str], Problem], chunk: str, part: str, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(idx, weights)`` as stored by ``store``; the tasks' files are deleted."""
    folder = new_path(spark, "exchange")
    given = problem(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        yield from train(given, chunk, part)

    try:
        rows = spark.range(0, given.tasks, 1, given.tasks).mapInArrow(run, "idx long, weights array<double>", barrier=True)
        return store(rows.repartition("idx"))  # Spark starts a stage of such tasks again only if a shuffle follows
    finally:
        delete_folder(spark, folder)
