"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the run of ``gram`` words in it
with the smallest hash. Consecutive windows with the same minimiser overlap in nearly all
their words, so they travel as one packed string, a super-k-mer, to the bucket of that
minimiser. Equal windows have equal minimisers and meet in one bucket, where sorting them
shows which one starts in a smaller id.

A chunk of documents is judged on its own first: a window that the chunk holds in a smaller
id is decided and stays at home. So a passage that a third of all documents share sends one
copy per chunk to its bucket, not one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import NO_ID_LAST, measured_lookup
from textloom.storage import materialise

BLOCK = 65_536
TRAVEL = "bucket int, places binary, words binary"
SPANS = "id long, high long, low long, from_word int, to_word int"
ROW = ["id", "high", "low"]
# Blobs are written once and moved once, so they are packed well rather than fast.
LEVEL = 6


@dataclass(frozen=True)
class SuperKmerConfig:
    """Chunks and buckets are sizes of work, none changes a result."""

    window: int = 13
    gram: int = 3
    chunk_words: int = 1 << 20
    bucket_bytes: int = 4 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _weighted(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words, from the hashes of the words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for j in range(n):
        total += hashes[j : len(hashes) - n + 1 + j] * np.uint64(xxhash.xxh64_intdigest(b"%d" % j, n) | 1)
    return _mixed(total)


def _sliding_minimum(values: np.ndarray, n: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= n:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (n - reach)], values[n - reach :])


def _numbered(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, and the hash of each word."""
    numbers: dict[bytes, int] = {}
    found = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    return found, hashes[found] if len(words) else np.zeros(0, np.uint64)


def _seen_before(words: np.ndarray, hashes: np.ndarray, starts: np.ndarray, order: np.ndarray, window: int) -> np.ndarray:
    """Which windows equal one of a smaller order. Sorts by hash and order, then compares the words themselves."""
    h = _weighted(hashes, window)[starts]
    by = np.lexsort((order, h))
    sorted_h, sorted_order = h[by], order[by]
    first = np.flatnonzero(np.concatenate(([True], sorted_h[1:] != sorted_h[:-1]))) if len(by) else np.zeros(0, np.int64)
    group = np.repeat(first, np.diff(np.append(first, len(by))))
    later = np.flatnonzero(sorted_order > sorted_order[group])
    seen = np.zeros(len(starts), bool)
    seen[by[later]] = True
    span = np.arange(window)
    for at in range(0, len(later), BLOCK):
        some = later[at : at + BLOCK]
        same = words[starts[by[some]][:, None] + span] == words[starts[by[group[some]]][:, None] + span]
        for clash in np.unique(group[some[~same.all(axis=1)]]):  # other words with an equal hash
            members = by[group == clash]
            smallest: dict[bytes, int] = {}
            for m in members:
                text = words[starts[m] : starts[m] + window].tobytes()
                smallest[text] = min(smallest.get(text, order[m]), order[m])
            for m in members:
                seen[m] = smallest[words[starts[m] : starts[m] + window].tobytes()] < order[m]
    return seen


def _runs(flags: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of set flags; a stretch goes on where ``same[i]`` links ``i`` to ``i + 1``."""
    linked = flags[1:] & flags[:-1] & same
    begin = np.flatnonzero(flags & np.concatenate(([True], ~linked)))
    end = np.flatnonzero(flags & np.concatenate((~linked, [True]))) + 1
    return begin, end


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Integers as differences, byte by byte of their places, compressed."""
    parts = [np.array([len(a) for a in arrays], np.int64).tobytes()]
    for a in arrays:
        parts.append(np.diff(a.astype(np.int64), prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes())
    return zstandard.compress(b"".join(parts), LEVEL)


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    sizes, at, out = np.frombuffer(data, np.int64, n), 8 * n, []
    for size in sizes.tolist():
        planes = np.frombuffer(data, np.uint8, 8 * size, at).reshape(8, size)
        out.append(np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel()))
        at += 8 * size
    return out


def _travel(batches: Iterator[pa.RecordBatch], buckets: int, config: SuperKmerConfig) -> Iterator[pa.RecordBatch]:
    """Rows for the buckets: the chunk's super-k-mers, and what the chunk itself has decided."""
    held: list[tuple[tuple[int, int, int], bytes]] = []
    size = 0
    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ROW), strict=True))
        texts = batch.column("text")
        for i in range(batch.num_rows):
            text = texts[i].as_py() or b""
            held.append((names[i], text))
            size += len(text)
            if size >= config.chunk_words * 6:
                yield _chunk(held, buckets, config)
                held, size = [], 0
    if held:
        yield _chunk(held, buckets, config)


def _chunk(documents: list[tuple[tuple[int, int, int], bytes]], buckets: int, config: SuperKmerConfig) -> pa.RecordBatch:
    documents = sorted(documents, key=lambda d: d[0])
    words: list[bytes] = []
    counts = np.zeros(len(documents), np.int64)
    for i, (_, text) in enumerate(documents):
        found = text.split()
        if len(found) >= config.window:
            counts[i] = len(found)
            words += found
    names = np.array([d[0] for d in documents], np.int64).reshape(-1, len(ROW))
    ids = names[:, 0]
    begins = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(documents), dtype=np.int32), counts)
    numbers, hashes = _numbered(words)
    n = max(0, len(words) - config.window + 1)
    inside = doc[:n] == doc[config.window - 1 :]
    starts = np.flatnonzero(inside)
    known = np.zeros(n, bool)
    known[starts] = _seen_before(numbers, hashes, starts, ids[doc[starts]], config.window)
    out: dict[str, list] = {"bucket": [], "places": [], "words": []}

    def row(bucket: int, of: np.ndarray, starts: np.ndarray, ends: np.ndarray, packed: bytes) -> None:
        used, local = np.unique(of, return_inverse=True)
        out["bucket"].append(bucket)
        out["places"].append(_packed([*names[used].T, local, starts, ends]))
        out["words"].append(zstandard.compress(packed, LEVEL) if packed else b"")

    none = np.zeros(0, np.int32)
    if known.any():
        covered = np.zeros(len(words) + 1, np.int32)
        np.add.at(covered, np.flatnonzero(known), 1)
        np.add.at(covered, np.flatnonzero(known) + config.window, -1)
        begin, end = _runs(np.cumsum(covered[:-1]) > 0, doc[1:] == doc[:-1])
        of = doc[begin]
        row(int(names[of[0]].sum()) % buckets, of, begin - begins[of], end - begins[of], b"")
    if n:
        grams = _weighted(hashes, config.gram)
        least = _sliding_minimum(grams, config.window - config.gram + 1)
        begin, end = _runs(inside & ~known, least[1:] == least[:-1])
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        heads = np.concatenate(([0], ends[:-1] + 1))
        bucket = (least[begin] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(bucket[by])) + 1, len(by))
        at = 0
        for cut in cuts:
            some = by[at:cut]
            at = cut
            if len(some):
                spans = zip(heads[begin[some]].tolist(), ends[end[some] + config.window - 2].tolist(), strict=True)
                packed = b"\n".join([joined[s:e] for s, e in spans])
                of = doc[begin[some]]
                row(int(bucket[some[0]]), of, begin[some] - begins[of], none, packed)
    types = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), types, strict=True)], list(out))


def _bucket(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """The spans of words that are covered by a window of this bucket seen in a smaller id."""
    out = []
    lines, names, run_start = [], [], []
    for r in rows.itertuples():
        *own, of, starts, ends = _unpacked(r.places, len(ROW) + 3)
        own = np.stack(own)[:, of]
        if r.words:
            lines += zstandard.decompress(r.words).split(b"\n")
            names.append(own)
            run_start.append(starts)
        else:
            out.append((*own, starts, ends))
    if lines:
        words: list[bytes] = []
        counts = np.zeros(len(lines), np.int64)
        for i, line in enumerate(lines):
            found = line.split(b" ")
            counts[i] = len(found)
            words += found
        names, run_start = np.concatenate(names, axis=1), np.concatenate(run_start)
        run = np.repeat(np.arange(len(counts)), counts)
        begins = np.cumsum(counts) - counts
        numbers, hashes = _numbered(words)
        del words, lines
        n = len(numbers) - window + 1
        starts = np.flatnonzero(run[:n] == run[window - 1 :])
        seen = np.zeros(n, bool)
        seen[starts] = _seen_before(numbers, hashes, starts, names[0][run[starts]], window)
        begin, end = _runs(seen, run[1:n] == run[: n - 1])
        of = run[begin]
        shift = run_start[of] - begins[of]
        out.append((*names[:, of], begin + shift, end + window - 1 + shift))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 5
    kinds = dict.fromkeys(ROW, "int64") | dict.fromkeys(("from_word", "to_word"), "int32")
    return pd.DataFrame(dict(zip(kinds, columns, strict=True))).astype(kinds)


def repeated_spans(documents: DataFrame, config: SuperKmerConfig = SuperKmerConfig()) -> DataFrame:
    """``(id, high, low, from_word, to_word)`` out of ``documents(id, high, low, text)``, of which the first three name
    a row: the words to remove, spans may overlap.

    A bucket holds about ``bucket_bytes`` of text, however many buckets that makes.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // config.bucket_bytes))
    travelling = documents.select(*ROW, F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda batches: _travel(batches, buckets, config), TRAVEL
    )
    return travelling.groupBy("bucket").applyInPandas(lambda rows: _bucket(rows, config.window), SPANS)


def _cut(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept_texts, totals, gone = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = (text.as_py() or b"").split()
            kept, at = [], 0
            for low, high in sorted((s["from_word"], s["to_word"]) for s in spans.as_py() or []):
                kept += words[at : max(at, low)]
                at = max(at, high)
            kept += words[at:]
            totals.append(len(words))
            gone.append(len(words) - len(kept))
            kept_texts.append(b" ".join(kept))
        digests = pa.array([hashlib.sha256(k).hexdigest() for k in kept_texts], pa.string())
        columns = {"doc_id": batch.column("doc_id"), "n_words": pa.array(totals, pa.int64()), "n_removed": pa.array(gone, pa.int64())}
        columns |= {"kept_sha256": digests} | ({"kept_text": pa.array(kept_texts, pa.binary())} if keep_text else {})
        yield pa.RecordBatch.from_pydict(columns)


def _named(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, id, text)`` with ``high`` and ``low``: a 128-bit digest of the text where the id alone does not tell
    rows apart, as it repeats or is missing, else 0, which takes no room on the way."""
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("id", F.lit(True).alias("_again"))
    marked = measured_lookup(rows, materialise(repeated, "repeated-ids"), "id")
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))

    def half(first: int):
        bits = F.conv(F.substring(digest, first, 16), 16, -10).cast("long")
        return F.when(F.col("_again"), bits).otherwise(F.lit(0).cast("long"))

    return marked.select("doc_id", "id", half(1).alias("high"), half(17).alias("low"), "text")


def remove_repeated_passages(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    config: SuperKmerConfig = SuperKmerConfig(),
    keep_text: bool = False,
) -> DataFrame:
    """Remove words covered by a window whose words also start a window in a smaller id.

    Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256``, one row per input row;
    ``keep_text`` adds ``kept_text``, the kept words joined by one space.

    Defined cases: a null text has no words; texts shorter than a window keep all theirs.
    Windows repeated inside one document, or between rows of one id, stay. A null id comes
    after all others: its repeats go, and it removes nothing. An empty table gives an empty
    table. Other columns are not read.
    """
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID_LAST)).alias("id"),
        F.col(text_column).alias("text"),
    )
    rows = _named(rows)
    spans = repeated_spans(rows, config)
    spans = spans.groupBy(*ROW).agg(F.collect_list(F.struct("from_word", "to_word")).alias("spans"))
    found = rows.join(spans, ROW, "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text binary" * keep_text
    cut = found.mapInArrow(lambda batches: _cut(batches, keep_text), schema)
    return cut.withColumn("kept_text", F.col("kept_text").cast("string")) if keep_text else cut


PASSAGES_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13),
hashed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM windows),
firsts AS (SELECT h, min(doc_id) AS first FROM hashed GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
  FROM hashed JOIN firsts USING (h) WHERE first < doc_id),
positions AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
judged AS (
  SELECT p.*, g.pos IS NOT NULL AS gone FROM positions p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos),
summed AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words d LEFT JOIN summed s ON s.doc_id = d.doc_id"""
