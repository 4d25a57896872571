"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents lie end to end, in a shuffled order, on a tape of words that is
cut into blocks of equally many words. The mix is a sequence of slots. Slot ``j`` has the
van der Corput point of ``j`` (its bits reversed), and the point falls into the interval of
one source among the cumulative targets, so every stretch of the mix holds the sources in
their shares. The ``k``-th slot of a source takes the ``k``-th block of its tape; past the
end the tape starts again. A source's last block is cut where its target is reached.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import null_safe, text_digest, with_offsets, words_in
from textloom.storage import materialise

HASH_BITS = 60


@dataclass(frozen=True)
class MixtureConfig:
    """``weights`` go round over the sources in code-point order; the mix holds ``share``
    times all words; no source gives more than ``repeats`` times its own.

    The schedule has a power of two of slots: ``2 ** min_slot_bits``, and more where a
    block would hold over ``max_block`` words.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2
    min_slot_bits: int = 17
    max_block: int = 65_536
    rows_per_part: int = 8_000


@dataclass(frozen=True)
class Mixture:
    """``rows(doc_id, digest, source, size, offset, source_size, target, quota)`` and the mix itself:
    ``pieces(slot, source, offset, from_word, words)``; ``(source, offset)`` names a document with words."""

    rows: DataFrame
    pieces: DataFrame


def source_targets(sources: DataFrame, config: MixtureConfig) -> DataFrame:
    """``(source, source_size)`` with ``target`` and ``quota`` (the target in whole words).

    Shares by weight; what a source cannot give is shared by the others by weight. Sorted
    by how soon a source is full, the sources before a row are full, and the level the
    others reach follows from sums over the rows before and behind. The windows are over
    one row per source.
    """
    whole = Window.partitionBy(F.lit(0))
    number = F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in config.weights]), (number % len(config.weights) + 1).cast("int"))
    ranked = sources.withColumn("_w", weight).withColumn("_most", F.col("source_size").cast("double") * config.repeats)
    ranked = ranked.withColumn("_full_at", F.col("_most") / F.col("_w"))
    filling = whole.orderBy("_full_at", F.col("source").asc_nulls_last())
    before, behind = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole).cast("double") * config.share
    level = (budget - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / F.sum("_w").over(behind)
    levelled = ranked.withColumn("_level", level)
    reached = F.max(F.when(F.col("_level") < F.col("_full_at"), F.col("_level"))).over(whole)
    target = F.when(F.col("_level") < F.col("_full_at"), F.col("_w") * reached).otherwise(F.col("_most"))
    return levelled.withColumn("target", target).select("source", "source_size", "target", F.round("target").cast("long").alias("quota"))


def mix_sources(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    config: MixtureConfig = MixtureConfig(),
    row_column: str | None = None,
) -> Mixture:
    """Schedule all documents; see the module for the method. ``row_column`` names a number of the row that the mixture's
    rows carry as ``row``, which tells equal rows apart.

    Defined cases: a null source is a source of its own, after all others. Null and empty
    texts have no words and are never taken. Null and repeated ids are fine: documents are
    ordered by a hash of id and text, and equal rows stand side by side. An empty table, or
    one without words, gives no pieces. Other columns are not read. Reruns agree.
    """
    spark = documents.sparkSession
    text = F.col(text_column)
    name = F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        text_digest(text).alias("digest"),
        F.col(source_column).alias("source"),
        words_in(text).alias("size"),
        F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long").alias("_hash"),
        *([F.col(row_column).alias("row")] if row_column else []),
    )
    sizes = materialise(rows, "sizes")
    totals = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    part_bits = max(0, (totals[0] // config.rows_per_part).bit_length())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sources, config), "targets")

    part = F.shiftright("_hash", HASH_BITS - part_bits)
    tape = with_offsets(sizes.withColumn("_part", part), "source", "_part", ["_hash", "doc_id", "size"], "size", "offset")
    tape = null_safe(tape.drop("_part"), targets, ["source"], "inner")
    tape = materialise(tape, "tape")

    wanted = int(totals[1] * config.share)
    bits = max(config.min_slot_bits, (wanted // config.max_block).bit_length())
    block = max(1, -(-wanted // 2**bits))
    slots = _schedule(spark, targets, bits, block)
    return Mixture(tape, _pieces(tape, slots, block, config.repeats))


def _schedule(spark, targets: DataFrame, bits: int, block: int) -> DataFrame:
    """``(source, slot, block)``: which block of which source each slot takes."""
    whole = Window.partitionBy(F.lit(0))
    upto = whole.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    shares = (
        targets.filter("quota > 0")
        .withColumn("_hi", F.sum("target").over(upto))
        .withColumn("_all", F.max("_hi").over(whole))
        .withColumn("_lo", F.greatest(F.col("_hi") - F.col("target"), F.lit(0.0)))
        .select("source", "quota", *[F.ceil(F.col(c) / F.col("_all") * 2**bits).alias(c) for c in ("_lo", "_hi")])
    )
    # An interval is joined through the cells that it touches, so no slot is compared to all sources.
    cell_bits = min(bits, 12)
    cells = shares.filter("_hi > _lo").withColumn(
        "_cell", F.explode(F.sequence(F.shiftright("_lo", bits - cell_bits), F.shiftright(F.col("_hi") - 1, bits - cell_bits)))
    )
    slots = spark.range(2**bits).withColumnRenamed("id", "slot")
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("long")
    slots = slots.withColumn("_point", point).withColumn("_cell", F.shiftright("_point", bits - cell_bits))
    taken = slots.join(cells, "_cell").filter("_point >= _lo and _point < _hi").select("source", "slot", "quota")
    taken = taken.withColumns({"_part": F.shiftright("slot", 14), "_one": F.lit(1)})
    ranked = with_offsets(taken, "source", "_part", ["slot"], "_one", "block")
    ranked = ranked.filter(F.col("block") * block < F.col("quota")).select("source", "slot", "block")
    ranked = materialise(ranked, "slots")
    # What the points leave over, a block or two of a source, goes to the end of the schedule.
    given = ranked.groupBy("source").agg(F.max("block").alias("_last"))
    short = null_safe(targets.filter("quota > 0"), given, ["source"], "left")
    first, last = F.coalesce(F.col("_last") + 1, F.lit(0)), F.floor((F.col("quota") - 1) / block)
    rest = short.filter(first <= last).select("source", F.lit(2**bits).alias("slot"), F.explode(F.sequence(first, last)).alias("block"))
    return ranked.unionByName(rest)


def _pieces(tape: DataFrame, slots: DataFrame, block: int, repeats: int) -> DataFrame:
    epochs = F.explode(F.array(*[F.lit(e).cast("long") for e in range(repeats)]))
    laid = (
        tape.filter("size > 0")
        .select("source", "offset", "size", "source_size", "quota", epochs.alias("_epoch"))
        .withColumn("_start", F.col("_epoch") * F.col("source_size") + F.col("offset"))
        .filter("_start < quota")
        .withColumn("_end", F.least(F.col("_start") + F.col("size"), F.col("quota")))
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block))))
    )
    joined = null_safe(laid, slots, ["source", "block"], "inner")
    low = F.greatest("_start", F.col("block") * block)
    high = F.least("_end", (F.col("block") + 1) * block)
    return joined.select("slot", "source", "offset", (low - F.col("_start")).alias("from_word"), (high - low).alias("words"))


def taken_words(mixture: Mixture) -> DataFrame:
    """``mixture.rows`` with ``taken``, the words that the pieces take of each, repeats counted."""
    sums = mixture.pieces.groupBy("source", "offset").agg(F.sum("words").alias("_taken"))
    joined = null_safe(mixture.rows, sums, ["source", "offset"], "left")
    taken = F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(0).cast("long")
    return joined.withColumn("taken", taken).drop("_taken")


def mixing_query(documents: DataFrame) -> DataFrame:
    mixed = taken_words(mix_sources(documents.select("doc_id", "text", "source")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS n
  FROM sized GROUP BY source),
ranked AS (SELECT *, [5.0, 2.0, 1.0][(n % 3)::INT + 1]::DOUBLE AS w, source_size::DOUBLE * 2 AS most FROM sources),
levels AS (
  SELECT *, most / w AS full_at,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY most / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (
  SELECT source, source_size, CASE WHEN level < full_at THEN w * max(CASE WHEN level < full_at THEN level END) OVER () ELSE most END AS target
  FROM levels),
tape AS (
  SELECT s.*, t.source_size, t.target, round(t.target)::BIGINT AS quota,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY h, doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sized s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - source_size - start)) END)::BIGINT AS taken
FROM tape"""
