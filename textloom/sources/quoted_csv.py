"""Large CSV files with line breaks inside quotes, read by all cores.

Spark's own reader takes such a file in one task, since a byte range does not tell whether it
begins inside a quoted value. Here every range is read under both assumptions first: a line
leaves the quotes open or closed depending on how it was entered, so a line, and a range of
lines, is a function from two states to two states. The functions of a file's ranges, one row
each, are composed in order, which gives the state every range really begins in. A second scan
then puts lines together within each range; only the pieces of records that cross a border,
at most two a range, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.columns import CORPUS_SCHEMA
from textloom.sources.corpus import CORRUPT, csv_fields
from textloom.storage import materialise

# One value of a line: in doubled quotes, with what follows the closing one, or without any.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
CLOSED = rf"\A(?:{FIELD},)*+{FIELD}\z"
QUOTE = '"'
# What a range takes in the broadcast table of entry states, amply.
RANGE_BYTES, MAX_RANGES_BYTES = 64, 256 * 1024 * 1024

RANGES = "file long, start long, from_closed boolean, from_open boolean, begins boolean"
PIECES = "record binary, file long, opener long, start long, header boolean"
PIECES_ARROW = pa.schema(
    [("record", pa.binary()), ("file", pa.int64()), ("opener", pa.int64()), ("start", pa.int64()), ("header", pa.bool_())]
)


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType = CORPUS_SCHEMA, keep_corrupt: bool = False
) -> DataFrame:
    """What :func:`textloom.sources.corpus.read_csv` returns with ``multiline``, from a scan in byte ranges.

    All files have a header, found by name, perhaps after a byte-order mark, and end their
    lines with a line feed, or all with carriage return and line feed, as the first line
    shows; the latter become line feeds inside values. Empty lines between records are no rows.
    A quote that is never closed takes the rest of its file into one value. Rows come in no order.

    Both scans have to cut the files alike. They do unless the session's settings or, for inputs of fewer
    ranges than cores, its cores change in between; the job then fails and does not return wrong rows.
    """
    fields, kept = csv_fields(spark, path, schema, multiline=True, keep_corrupt=keep_corrupt)
    lines = _lines(spark, path)
    ranges = materialise(lines.drop("value").mapInArrow(_range_functions, RANGES), "csv-ranges")
    entered = materialise(_entered(ranges), "csv-entered")
    if entered.count() > MAX_RANGES_BYTES // RANGE_BYTES:
        raise ValueError(f"{path} has too many ranges; raise spark.sql.files.maxPartitionBytes")
    # A broadcast join leaves the lines of a task in the order of the scan.
    placed = lines.join(F.broadcast(entered), ["file", "start"], "left")
    cut_alike = F.col("inside").isNotNull() | (F.col("start") == 0)
    differs = F.raise_error(F.lit("the files were cut differently by the second scan")).cast("boolean")
    known = placed.withColumn("inside", F.when(cut_alike, F.coalesce("inside", F.lit(False))).otherwise(differs))
    pieces = known.select("file", "start", "value", "from_closed", "from_open", "inside", "opener").mapInArrow(_pieces, PIECES)
    stored = materialise(pieces, "csv-pieces")
    whole = stored.filter(F.col("opener").isNull()).select("record")
    crossing = (
        stored.filter(F.col("opener").isNotNull())
        .groupBy("file", "opener")
        .agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"), F.bool_or("header").alias("header"))
        .filter(~F.col("header"))
        .select(F.array_join(F.transform("parts", lambda p: p["record"].cast("string")), "\n").cast("binary").alias("record"))
    )
    options = {"escape": QUOTE, "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = F.from_csv(F.col("record").cast("string"), ddl, options)
    return whole.unionByName(crossing).select(parsed.alias("row")).select(*[F.col("row")[name].alias(name) for name in kept])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines with file and start of their range, and whether quotes are open after them."""
    text = spark.read.option("lineSep", "\n").text(path)
    first = text.first()
    value = F.col("value")
    if first is not None and first["value"].endswith("\r"):
        value = F.when(value.endswith("\r"), F.left(value, F.char_length(value) - 1)).otherwise(value)
    located = text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), value.alias("value")
    )

    def leaves_open(line: Column) -> Column:
        return ~line.rlike(CLOSED)

    plain = ~F.col("value").contains(QUOTE)
    return located.select(
        "file",
        "start",
        F.col("value").cast("binary").alias("value"),
        F.when(plain, False).otherwise(leaves_open(F.col("value"))).alias("from_closed"),
        F.when(plain, True).otherwise(leaves_open(F.concat(F.lit(QUOTE), F.col("value")))).alias("from_open"),
    )


def _after(from_closed: np.ndarray, from_open: np.ndarray, start: bool) -> np.ndarray:
    """Whether quotes are open after each line: what the last line that does not depend on its
    entry says, turned once by each later line that swaps the states."""
    fixed = from_closed == from_open
    turns = np.cumsum(from_closed & ~from_open)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    base = np.where(last >= 0, from_closed[last], start)
    return base ^ ((turns - np.where(last >= 0, turns[last], 0)) % 2 == 1)


def _before(after: np.ndarray, start: bool) -> np.ndarray:
    return np.concatenate([[start], after[:-1]])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The batches, cut where another range begins."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield (int(file[low]), int(start[low])), batch.slice(low, high - low)


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("from_closed", "from_open"))


def _range_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: open at its end if entered closed, and if entered open; whether a record begins in it in the latter case."""
    found: dict[tuple[int, int], list[bool]] = {}
    for key, batch in _runs(batches):
        state = found.setdefault(key, [False, True, False])
        closed, opened = (_after(*_flags(batch), start) for start in state[:2])
        begins = state[2] or bool((~_before(opened, state[1])).any())
        found[key] = [bool(closed[-1]), bool(opened[-1]), begins]
    rows = [(*key, *state) for key, state in found.items()]
    names = ("file", "start", "from_closed", "from_open", "begins")
    types = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _entered(ranges: DataFrame) -> DataFrame:
    """Per range but the first of a file: ``inside``, if it begins inside quotes, and ``opener``, the range in
    which the record that goes on there began. The window holds a row per range of one file."""
    order = Window.partitionBy("file").orderBy("start")
    upto, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("from_closed") & ~F.col("from_open")).cast("int")).over(upto)
    fixed = F.when(F.col("from_closed") == F.col("from_open"), F.struct(F.col("from_closed").alias("open"), "turns"))
    open_after = F.coalesce(F.col("fixed.open"), F.lit(False)).cast("int") + F.col("turns") - F.coalesce("fixed.turns", F.lit(0))
    return (
        ranges.withColumn("turns", turns)
        .withColumn("fixed", F.last(fixed, ignorenulls=True).over(upto))
        .withColumn("inside", F.lag(open_after % 2 == 1, 1, False).over(order))
        .withColumn("opener", F.last(F.when(~F.col("inside") | F.col("begins"), F.col("start")), ignorenulls=True).over(earlier))
        .filter(F.col("start") > 0)
        .select("file", "start", "inside", "opener")
    )


@dataclass
class _Range:
    """One range of a file while its lines go by."""

    file: int
    start: int
    open: bool
    # The range that the unfinished record began in, if not in this one.
    opener: int | None
    pending: list[bytes] = field(default_factory=list)
    # The first record of a file is its header.
    header_due: bool = False
    out: list[tuple] = field(default_factory=list)

    def finished(self, records: list[bytes]) -> None:
        records = [r for r in records if r]
        if self.header_due and records:
            self.header_due, records = False, records[1:]
        self.out += [(r, None, None, None, False) for r in records]

    def crossing(self, opener: int) -> None:
        self.out.append((b"\n".join(self.pending), self.file, opener, self.start, self.header_due))
        self.pending = []

    def take(self, batch: pa.RecordBatch) -> None:
        after = _after(*_flags(batch), self.open)
        begins = np.flatnonzero(~_before(after, self.open))
        lines = batch.column("value").to_pylist()
        self.open = bool(after[-1])
        if not len(begins):
            self.pending += lines
            return
        self.pending += lines[: begins[0]]
        if self.opener is not None:
            self.crossing(self.opener)
            self.opener = None
        elif self.pending:
            self.finished([b"\n".join(self.pending)])
        ends = [*begins[1:], len(lines)]
        records = [lines[a] if b == a + 1 else b"\n".join(lines[a:b]) for a, b in zip(begins, ends, strict=True)]
        self.pending = lines[begins[-1] :] if self.open else []
        self.finished(records[:-1] if self.open else records)

    def end(self) -> None:
        if self.opener is not None:
            self.crossing(self.opener)
        elif self.open:
            self.crossing(self.start)
        elif self.pending:
            self.finished([b"\n".join(self.pending)])
            self.pending = []

    def drain(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = list(zip(*rows, strict=True)) or [()] * len(PIECES_ARROW)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, PIECES_ARROW, strict=True)], schema=PIECES_ARROW
        )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the pieces of those that cross a border of ranges with the range they began in."""
    at: _Range | None = None
    for (file, start), batch in _runs(batches):
        if at is None or (at.file, at.start) != (file, start):
            if at is not None:
                at.end()
                yield at.drain()
            inside = batch.column("inside")[0].as_py()
            opener = batch.column("opener")[0].as_py() if inside else None
            at = _Range(file, start, inside, opener, header_due=start == 0)
        at.take(batch)
        yield at.drain()
    if at is not None:
        at.end()
        yield at.drain()
