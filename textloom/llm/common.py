"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.sizing import skew_safe_lookup

# The six blanks that end a word: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A table of so many rows of a few numbers or digests is sent to every executor, some tens of MB.
MAX_LOOKUP_ROWS = 200_000
# Stand for a missing id where ids are ordered: before and after all others.
NO_ID, NO_ID_LAST = -(2**63), 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; no other letter changes."""
    return F.translate(text, UPPER, LOWER)


def words_in(text: Column) -> Column:
    """Number of words, null for none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def text_digest(text: Column) -> Column:
    """With the id, this tells rows apart. Rows that agree in both are copies and get the same result."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def hex64(value: Column) -> Column:
    """16 lowercase hex digits of a long, as unsigned."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys go."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for c in keys:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in keys])


def measured_lookup(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """Left join to a stored table with one row per ``key`` and a few numbers or digests beside it.

    It is counted first: a small one travels, beyond ``MAX_LOOKUP_ROWS`` all keys are split
    and joined by shuffle.
    """
    if keyed.count() <= MAX_LOOKUP_ROWS:
        return rows.join(F.broadcast(keyed), key, "left")
    return skew_safe_lookup(rows, keyed, key, "left")


def with_offsets(df: DataFrame, group: str, part: str, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before a row in its ``group``.

    ``part`` grows with ``order`` and cuts a group into parts of bounded size, so that no
    window holds a whole group: sums per part, a running sum over parts, and a running
    sum inside each part.
    """
    parts = df.groupBy(group, part).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    based = parts.select(group, part, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        null_safe(df, based, [group, part], "inner")
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_base")
    )


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches that are sorted by ``keys``, none of them null.

    A group that may go on in the next batch is held back until it is complete.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns, strict=True)):
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.argmax(np.logical_and.reduce([c == c[-1] for c in columns])))
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)
