"""Size-checked broadcasts and joins that hold when one key owns most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# A class list, or anything with one row per class. Class lists travel to the driver, into
# plans and into one window, so a column that is no label column has to fail early.
MAX_CLASSES = 1_000
# A table of this measured size is sent to every executor; built as a hash table, the driver holds it several times over.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A key of a skew-safe join is split so many ways.
SALTS = 16


def per_class_table() -> WindowSpec:
    """A window for totals over a table that has one row per class, never one that grows with the data."""
    return Window.partitionBy(F.lit(0))


def bounded(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    """``df`` unchanged, but the running job fails when it has more than ``max_rows`` rows.

    Only one row more than that is ever brought together to find out.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    over = F.raise_error(F.lit(f"too many {what}: more than {max_rows}"))
    return (
        df.limit(max_rows + 1)
        .withColumn("_size", size)
        .filter(F.when(F.col("_size") > max_rows, over.cast("boolean")).otherwise(F.lit(True)))
        .drop("_size")
    )


def bounded_broadcast(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    return F.broadcast(bounded(df, max_rows, what))


def bounded_collect(df: DataFrame, max_rows: int, what: str) -> list:
    """Bring a per-class table to the driver; one row more than allowed is an error."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"too many {what}: more than {max_rows}")
    return rows


def skew_safe_lookup(rows: DataFrame, keyed: DataFrame, key: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``rows`` to a table with one row per ``key``, with every key split ``salts`` ways.

    The keyed table is repeated once per salt and a row picks its salt from a hash of all
    its columns, so a key that owns most rows, known to the table or not, is spread over
    that many tasks; adaptive execution splits further. Nothing is broadcast, and no count
    of hot keys has to fit anywhere. Null keys match nothing.
    """
    payload = [c for c in keyed.columns if c != key]
    copies = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    return salted.join(copies, [key, "_salt"], how).select(*rows.columns, *payload)
