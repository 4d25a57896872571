"""Exact stratified train/test splits.

Each row gets a seeded order key from its id, and a label's test rows are the
first ones in that order up to the label's quota. Sorting a label as a whole
would put the biggest class into one task. The last key inside the quota is found
by distributed selection instead: counts per key prefix locate the prefix in which the quota
runs out, and only that prefix is taken further apart. After that a row is
assigned by comparing its own key with one value per label, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.operators.audit import digest
from textloom.sizing import (
    MAX_CLASSES,
    per_class_table,
    bounded_collect,
    skew_safe_lookup,
)
from textloom.storage import materialise

# 65,536 prefixes per label at a time.
PREFIX_HEX_DIGITS = 4
KEY_DIGITS = 32


def order_key(id_column: str, seed: int) -> Column:
    """A seeded pseudo-random order that does not depend on partitioning; a missing id stands as no characters."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))


def tie_key(df: DataFrame, columns: Columns) -> Column:
    """What orders rows of one id: a digest of the text, where there is one."""
    return F.md5(F.coalesce(F.col(columns.text), F.lit("")) if columns.text in df.columns else F.lit(""))


def split_quota(df: DataFrame, test_size: float = 0.2, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Test rows per label: ``ceil(test_size * N)`` rows shared out by largest remainder."""
    counts = df.groupBy(F.col(columns.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return quota(counts, test_size)


def quota(counts: DataFrame, test_size: float) -> DataFrame:
    """``label, n, n_train, n_test`` out of ``label, n``. Products of two counts are decimals, as they
    exceed 64 bits from some billions of rows."""
    whole = "decimal(38,0)"
    total = F.sum(F.col("n").cast("decimal(19,0)")).over(per_class_table()).cast("decimal(19,0)")
    draws = F.ceil(F.col("_total") * F.lit(Decimal(str(test_size)))).cast("decimal(19,0)")
    shares = (
        counts.withColumn("_total", total)
        .withColumn("_draws", draws)
        .withColumn("_product", (F.col("_draws") * F.col("n").cast("decimal(19,0)")).cast(whole))
        .withColumn("_base", F.expr("_product div cast(_total as decimal(38,0))"))
        .withColumn("_remainder", F.col("_product") - (F.col("_base").cast("decimal(19,0)") * F.col("_total")).cast(whole))
    )
    by_remainder = per_class_table().orderBy(F.desc("_remainder"), F.asc("label"))
    left_over = F.col("_draws").cast("long") - F.sum("_base").over(per_class_table())
    extra = (F.row_number().over(by_remainder) <= left_over).cast("long")
    return shares.select("label", "n", (F.col("_base") + extra).alias("n_test")).select(
        "label", "n", (F.col("n") - F.col("n_test")).alias("n_train"), "n_test"
    )


@dataclass(frozen=True)
class StratifiedSplit:
    """A fitted split: per label the last order key that belongs to the test side.

    ``thresholds`` has ``_label, _key, _tie, _take``. ``_tie`` is null where the key decides. ``_take`` is null unless
    copies share the last key and only so many of them belong to the test side.
    """

    thresholds: DataFrame
    seed: int
    columns: Columns
    ties: bool = False
    partial: bool = False

    def assign(self, df: DataFrame) -> DataFrame:
        """Adds ``split`` = ``train`` or ``test``; a row-local comparison, but for copies at the border."""
        key = order_key(self.columns.id, self.seed)
        below, equal = key < F.col("_key"), key == F.col("_key")
        if self.ties:
            tie = tie_key(df, self.columns)
            below = below | (equal & (tie < F.col("_tie")))
            equal = equal & (F.col("_tie").isNull() | (tie == F.col("_tie")))
        joined = df.join(F.broadcast(self.thresholds), df[self.columns.label].eqNullSafe(F.col("_label")), "left")
        added = ["_label", "_key", "_tie", "_take"]
        if not self.partial:
            return joined.withColumn("split", F.when(below | equal, "test").otherwise("train")).drop(*added)
        border = F.coalesce(equal & F.col("_take").isNotNull(), F.lit(False))
        clear = joined.filter(~border).withColumn("split", F.when(below | equal, "test").otherwise("train"))
        # Copies, equal in label, id and text: they are numbered within their partitions, and counts per partition
        # say where the partition's numbers start.
        copies = materialise(joined.filter(border).withColumn("_at", F.monotonically_increasing_id()), "copies")
        part = F.shiftright("_at", 33)
        sizes = copies.groupBy("_label", part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
        ahead = F.sum("_size").over(Window.partitionBy("_label").orderBy("_part")) - F.col("_size")
        starts = sizes.select(F.col("_label").alias("_l"), F.col("_part").alias("_p"), ahead.alias("_before"))
        within = F.row_number().over(Window.partitionBy("_label", "_part").orderBy("_at"))
        numbered = copies.withColumn("_part", part).withColumn("_within", within)
        same = F.col("_label").eqNullSafe(F.col("_l")) & (F.col("_part") == F.col("_p"))
        dealt = numbered.join(starts, same).withColumn(
            "split", F.when(F.col("_before") + F.col("_within") <= F.col("_take"), "test").otherwise("train")
        )
        wanted = [*df.columns, "split"]
        return clear.select(*wanted).unionByName(dealt.select(*wanted))


def _common(low: str, high: str) -> int:
    n = 0
    while n < len(low) and low[n] == high[n]:
        n += 1
    return n


def fit_stratified_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, columns: Columns = DEFAULT_COLUMNS
) -> StratifiedSplit:
    """Find the thresholds; ids may repeat or be missing.

    The order is that of a digest of the seed and the id, then a digest of the text. Counts per prefix of the
    digests say in which prefix a label's quota runs out; that prefix is taken apart by longer ones until few distinct
    digests are left. Rows equal in label, id and text are copies: they are counted, and which of
    them are drawn does not matter. The driver gets a row per label.
    """
    spark = df.sparkSession
    label = F.col(columns.label).alias("label")
    counts = materialise(split_quota(df, test_size, columns).select("label", "n_test").filter("n_test > 0"), "quota")
    open_labels = {r.label: ("", r.n_test) for r in bounded_collect(counts, MAX_CLASSES, "labels")}
    key, both = order_key(columns.id, seed), F.concat(order_key(columns.id, seed), tie_key(df, columns))
    found: list[tuple] = []
    wide = False
    while open_labels:
        depth = max(len(prefix) for prefix, _ in open_labels.values())
        # The text is read only where ids alone leave too many rows together.
        wide = wide or depth >= KEY_DIGITS
        rows = df.select(label, (both if wide else key).alias("digits"))
        borders = spark.createDataFrame([(k, p, r) for k, (p, r) in open_labels.items()], "_l string, _prefix string, _rank long")
        rows = rows.join(F.broadcast(borders), F.col("label").eqNullSafe(F.col("_l")) & F.col("digits").startswith(F.col("_prefix")))
        prefix = F.substring("digits", F.lit(1), F.length("_prefix") + PREFIX_HEX_DIGITS)
        groups = rows.groupBy("label", "_rank", prefix.alias("prefix")).agg(
            F.count(F.lit(1)).alias("n"), F.min("digits").alias("low"), F.max("digits").alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy("label").orderBy("prefix"))
        last = groups.withColumn("upto", upto).filter("upto >= _rank and upto - n < _rank")
        picked = bounded_collect(last.select("label", "prefix", "low", "high", "n", (F.col("_rank") - F.col("upto") + F.col("n")).alias("rank")), MAX_CLASSES, "labels")
        open_labels = {}
        for r in picked:
            if r.low != r.high:
                open_labels[r.label] = (r.low[: max(len(r.prefix), _common(r.low, r.high))], r["rank"])
            elif r["rank"] == r.n:  # all rows of the last key
                found.append((r.label, r.low[:KEY_DIGITS], r.low[KEY_DIGITS:] or None, None))
            elif wide:  # some of its copies
                found.append((r.label, r.low[:KEY_DIGITS], r.low[KEY_DIGITS:], r["rank"]))
            else:
                open_labels[r.label] = (r.low, r["rank"])
    schema = "_label string, _key string, _tie string, _take long"
    kind = df.schema[columns.label].dataType
    thresholds = spark.createDataFrame(found, schema).withColumn("_label", F.col("_label").cast(kind))
    return StratifiedSplit(thresholds, seed, columns, any(f[2] for f in found), any(f[3] for f in found))


def stratified_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, columns: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    return fit_stratified_split(df, test_size, seed, columns).assign(df)


def group_split(
    prepared: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    columns: Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """A split in which all copies of a cleaned text land on the same side.

    The distinct texts are split, each under its smallest label, and the rows
    follow their text.
    """
    keyed = prepared.withColumn("_digest", digest(columns.cleaned))
    groups = materialise(keyed.groupBy("_digest").agg(F.min(columns.label).alias("_stratum")), "text-groups")
    by_text = Columns(id="_digest", label="_stratum")
    sides = stratified_split(groups, test_size, seed, by_text).select("_digest", "split")
    return skew_safe_lookup(keyed, sides, "_digest").drop("_digest")
