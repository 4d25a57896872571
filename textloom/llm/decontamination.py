"""Benchmark decontamination with an FM-index per training shard.

A task turns its documents into shards of bounded size. Words of the benchmark have numbers;
all other words are one symbol that no phrase holds, and stretches of benchmark words too
short for any phrase are folded into it, so the index holds what can match and no more.
Every phrase of the benchmark is searched backwards through the shard's wavelet ranks,
occurrences are located by sampled suffix positions, and their spans merged.

The benchmark travels to the tasks in blocks of bounded size; each block meets all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import null_safe, text_digest
from textloom.llm.fm_index import FMIndex

# Letters, digits and everything beyond ASCII make words; A-Z is lowered on the way.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOUND = "doc_id long, digest binary, n_words long, spans array<struct<from_word:int,to_word:int>>, items array<string>"


@dataclass(frozen=True)
class LeakConfig:
    """``phrase`` words make a window. The other values are sizes of work, none changes a result."""

    phrase: int = 10
    shard_words: int = 1 << 20
    sample: int = 16
    block_bytes: int = 8 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Phrases:
    """Distinct windows of some items; ``patterns`` are right-aligned, ``items[i]`` are those that hold window ``i``."""

    numbers: dict[bytes, int]
    patterns: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @staticmethod
    def of(rows: list[tuple[str, bytes]], phrase: int) -> Phrases:
        numbers: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = {}
        for item, text in rows:
            found = [numbers.setdefault(w, len(numbers) + 2) for w in words_of(text)]
            for i in range(max(1, len(found) - phrase + 1) if found else 0):
                holders.setdefault(tuple(found[i : i + phrase]), set()).add(item)
        patterns = np.zeros((len(holders), phrase), np.int64)
        for i, window in enumerate(holders):
            patterns[i, phrase - len(window) :] = window
        lengths = np.array([len(w) for w in holders], np.int64)
        return Phrases(numbers, patterns, lengths, [sorted(h) for h in holders.values()])


def _search_shard(symbols: np.ndarray, doc: np.ndarray, at: np.ndarray, phrases: Phrases, config: LeakConfig):
    """Spans ``(doc, from, to)`` and pairs ``(doc, window)`` in a shard; ``doc`` and ``at`` say where each symbol stands."""
    index = FMIndex(np.append(symbols, 0), len(phrases.numbers) + 2, config.sample)
    low, high = index.search(phrases.patterns, phrases.lengths)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
    start = index.locate(rows)
    covered = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + phrases.lengths[window], -1)
    hit = np.cumsum(covered[:-1]) > 0
    linked = hit[1:] & hit[:-1]  # stretches never cross a separator, so never a document
    begin = np.flatnonzero(hit & np.concatenate(([True], ~linked)))
    end = np.flatnonzero(hit & np.concatenate((~linked, [True])))
    pairs = np.unique(np.stack([doc[start], window], axis=1), axis=0)
    return (doc[begin], at[begin], at[end] + 1), pairs


def _shard(texts: list[list[bytes]], phrases: Phrases, config: LeakConfig):
    """Per document the merged spans and the items found."""
    spans, items = [[] for _ in texts], [set() for _ in texts]
    counts = np.array([len(t) for t in texts], np.int64)
    if counts.sum() and len(phrases.lengths):
        total = int(counts.sum()) + len(texts)  # one place behind each document keeps them apart
        found = np.ones(total, np.int64)
        begins = np.cumsum(counts + 1) - (counts + 1)
        for begin, words in zip(begins, texts, strict=True):
            found[begin : begin + len(words)] = np.fromiter(map(phrases.numbers.get, words, repeat(1)), np.int64, len(words))
        doc = np.repeat(np.arange(len(texts)), counts + 1)
        at = np.arange(total) - begins[doc]
        known = found > 1
        begin = np.flatnonzero(known & np.concatenate(([True], ~known[:-1])))
        size = np.flatnonzero(known & np.concatenate((~known[1:], [True]))) + 1 - begin
        # A stretch that may hold a phrase stays, with the place behind it as separator.
        stays = size >= phrases.lengths.min()
        begin, size = begin[stays], size[stays] + 1
        keep = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        if len(keep):
            (of, low, high), pairs = _search_shard(found[keep], doc[keep], at[keep], phrases, config)
            for d, a, b in zip(of.tolist(), low.tolist(), high.tolist(), strict=True):
                spans[d].append({"from_word": a, "to_word": b})
            for d, w in pairs.tolist():
                items[d].update(phrases.items[w])
    return spans, [sorted(i) for i in items]


def _find(batches: Iterator[pa.RecordBatch], phrases: Phrases, config: LeakConfig) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("from_word", pa.int32()), ("to_word", pa.int32())]))), ("items", pa.list_(pa.string())),
        ]
    )
    for batch in batches:
        at, texts, size = 0, [], 0
        for i in range(batch.num_rows):
            texts.append(words_of(batch.column("text")[i].as_py()))
            size += len(texts[-1])
            if size >= config.shard_words or i == batch.num_rows - 1:
                spans, items = _shard(texts, phrases, config)
                part = batch.slice(at, len(texts))
                columns = [part.column("doc_id"), part.column("digest"), [len(t) for t in texts], spans, items]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )
                at, texts, size = i + 1, [], 0


def _merge(spans: pd.Series) -> pd.Series:
    def one(found):
        out = []
        for low, high in sorted((s["from_word"], s["to_word"]) for s in found):
            if out and low <= out[-1]["to_word"]:
                out[-1]["to_word"] = max(out[-1]["to_word"], high)
            else:
                out.append({"from_word": low, "to_word": high})
        return out

    return spans.map(one)


def benchmark_spans(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    config: LeakConfig = LeakConfig(),
) -> DataFrame:
    """``(doc_id, digest, n_words, spans, items)``, one row per input row.

    ``spans`` are the merged stretches of words, end exclusive, inside occurrences of a
    window of the benchmark; ``items`` the ids, as sorted strings, of the items with an
    occurring window. ``digest`` is that of the text, so id and digest tell rows apart.

    Defined cases: null, empty and wordless texts have no words and no spans; such items
    have no window; an item shorter than a window is one window. Items of one id are one
    item, a null id is named ``null``. An empty benchmark finds nothing; an empty table
    gives an empty table. Equal rows get equal results. Other columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_digest(F.col(text_column)).alias("digest"),
        F.col(text_column).cast("binary").alias("text"),
    )
    items = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("null")).alias("item"),
        F.col(item_text_column).cast("binary").alias("text"),
    ).filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = max(1, -(-size // config.block_bytes))
    found = None
    for block in range(blocks):
        own = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        phrases = spark.sparkContext.broadcast(Phrases.of([(r.item, bytes(r.text)) for r in own.collect()], config.phrase))
        part = rows.mapInArrow(lambda b, p=phrases: _find(b, p.value, config), FOUND)
        found = part if found is None else found.unionByName(part)
    if blocks == 1:
        return found
    merged = F.pandas_udf(_merge, "array<struct<from_word:int,to_word:int>>")
    together = found.groupBy("doc_id", "digest").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    together = together.withColumn("spans", merged("spans"))
    return null_safe(rows.select("doc_id", "digest"), together, ["doc_id", "digest"], "inner")


def leaks_query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = benchmark_spans(documents, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to_word"] - s["from_word"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of ``spans`` and what stands between them."""
    if text is None or not spans:
        return text
    words = list(_WORD.finditer(text))
    kept, at = [], 0
    for low, high in sorted(spans):
        kept.append(text[at : words[low].start()])
        at = words[high - 1].end()
    return "".join([*kept, text[at:]])


LEAKS_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0),
phrases AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS phrase, least(10, len(w)) AS n FROM starts),
sizes AS (SELECT DISTINCT n FROM phrases),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.i, p.n, f.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM places) p JOIN phrases f USING (phrase, n)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id"""
