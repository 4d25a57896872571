"""Document fingerprints by locally consistent parsing.

The code points of a text are parsed into phrases, the phrases into phrases of phrases, up
to one symbol. Runs of one symbol become one symbol first. Then deterministic coin tossing
labels each symbol from itself and a few symbols to its left: the lowest bit where a symbol
differs from its left neighbour, twice its place plus its value. Four rounds bring 64-bit names
down to six labels, neighbours still differing, and phrases begin at the largest labels
around. A phrase's name is a hash of the names in it, so equal substrings have equal names
inside, wherever they stand; only the phrases at their rims differ.

A fingerprint is the name of the whole text and the smallest hashes of the names of all its
longer phrases. The share of common hashes among the smallest of two fingerprints estimates
how many phrases two texts share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import NO_ID

_WEIGHTS = np.random.default_rng(2024).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class ParsingConfig:
    """Phrases of ``min_phrase`` code points or more go into the sketch of ``sketch`` hashes.
    Chunks and buckets are sizes of work, neither changes a result; a bucket is streamed, so it may
    be larger where ``most_buckets`` of them are not enough."""

    min_phrase: int = 4
    sketch: int = 64
    chunk_chars: int = 1 << 17
    bucket_bytes: int = 4 << 20
    most_buckets: int = 100_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _tossed(names: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which a name differs from its left neighbour, plus the bit."""
    differ = names ^ left
    lowest = differ & -differ
    place = np.bitwise_count(lowest - names.dtype.type(1))
    return 2 * place + ((names & lowest) != 0)


def _phrase_starts(names: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where phrases begin, given where documents begin and end; neighbours within a document differ."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[begins] = ~names[begins]
    labels = _tossed(names, left).astype(np.uint8)
    for _ in range(3):
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[begins] = labels[begins] ^ 1
        labels = _tossed(labels, left).astype(np.uint8)
    start = np.zeros(len(names), bool)
    start[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # No phrase of one symbol at the rims, so every level is at most half as long.
    start[ends - 1] = False
    second = begins + 1
    start[second[second < len(names)]] = False
    start[begins] = True
    return start


def fingerprints(texts: list[str], config: ParsingConfig = ParsingConfig()) -> list[str]:
    """One string per text: 16 hex digits for the whole, then 8 per hash of the sketch, ascending."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    roots = np.zeros(len(texts), np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    names, size = _mixed(codes.astype(np.uint64) + np.uint64(1)), np.ones(len(codes), np.int32)
    found_doc, found_name = [], []
    while len(names):
        same = doc[1:] == doc[:-1]
        head = np.concatenate(([True], ~((names[1:] == names[:-1]) & same)))
        if not head.all():
            at = np.flatnonzero(head)
            length = np.diff(np.append(at, len(names)))
            size, doc = np.add.reduceat(size, at), doc[at]
            run = names[at]
            names = np.where(length > 1, _mixed(run + length.astype(np.uint64) * _WEIGHTS[0]), run)
        begins = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        ends = np.append(begins[1:], len(names))
        single = ends - begins == 1
        if single.any():
            done = begins[single]
            roots[doc[done]] = names[done]
            found_doc.append(doc[done])
            found_name.append(names[done])
            left = np.ones(len(names), bool)
            left[done] = False
            names, size, doc = names[left], size[left], doc[left]
            if not len(names):
                break
            begins = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            ends = np.append(begins[1:], len(names))
        at = np.flatnonzero(_phrase_starts(names, begins, ends))
        inside = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
        weighted = _mixed(names) * _WEIGHTS[inside % len(_WEIGHTS)]
        names, size, doc = _mixed(np.add.reduceat(weighted, at)), np.add.reduceat(size, at), doc[at]
        long = size >= config.min_phrase
        found_doc.append(doc[long])
        found_name.append(names[long])
    if not found_doc:
        return [f"{0:016x}"] * len(texts)
    key = np.unique((np.concatenate(found_doc).astype(np.uint64) << np.uint64(32)) | (_mixed(np.concatenate(found_name)) >> np.uint64(32)))
    owner = (key >> np.uint64(32)).astype(np.int64)
    low = np.searchsorted(owner, np.arange(len(texts)))
    high = np.minimum(np.searchsorted(owner, np.arange(len(texts)), side="right"), low + config.sketch)
    digits = (key & np.uint64(0xFFFFFFFF)).astype(">u4").tobytes().hex()
    return [f"{root:016x}" + digits[8 * a : 8 * b] for root, a, b in zip(roots.tolist(), low.tolist(), high.tolist(), strict=True)]


def likeness(a: str, b: str, sketch: int = 64) -> float:
    """Estimated share of common phrases: 1 for equal fingerprints, 0 where nothing is shared."""
    if a == b:
        return 1.0
    mine, theirs = ({f[i : i + 8] for i in range(16, len(f), 8)} for f in (a, b))
    smallest = sorted(mine | theirs)[:sketch]
    return sum(h in mine and h in theirs for h in smallest) / len(smallest) if smallest else 0.0


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by as many from the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch], config: ParsingConfig) -> Iterator[pa.RecordBatch]:
    """Documents in order, each with the text that follows; the rows of a bucket end with what follows its last."""
    waiting: list[tuple[int | None, str]] = []
    bucket, closed, chars = None, False, 0
    for batch in batches:
        buckets, extras = batch.column("bucket").to_pylist(), batch.column("extra").to_pylist()
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        for i in range(batch.num_rows):
            text = texts[i].as_py() or ""
            if buckets[i] != bucket:
                bucket, closed = buckets[i], False
            if waiting and (extras[i] or chars >= config.chunk_chars):
                yield _compared(waiting, text, config)
                waiting, chars = [], 0
                closed = closed or extras[i]
            if not extras[i] and not closed:
                waiting.append((ids[i], text))
                chars += len(text)


def _compared(rows: list[tuple[int | None, str]], following: str, config: ParsingConfig) -> pa.RecordBatch:
    texts = [t for _, t in rows] + [following]
    edited = [edited_text(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    own, new = fingerprints(texts, config), fingerprints(edited, config)
    columns = {
        "doc_id": pa.array([i for i, _ in rows], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        "fingerprint": pa.array(own[:-1]),
        "edited_fingerprint": pa.array(new),
        "near_edited": pa.array([likeness(a, b, config.sketch) for a, b in zip(own, new, strict=False)], pa.float64()),
        "near_next": pa.array([likeness(a, b, config.sketch) for a, b in zip(own[:-1], own[1:], strict=True)], pa.float64()),
    }
    return pa.RecordBatch.from_pydict(columns)


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", config: ParsingConfig = ParsingConfig()
) -> DataFrame:
    """Fingerprint every text and its edited text, whose last half is the start of the next document's.

    Next is by descending id, and the first follows the last. Texts move once: ranges of ids
    are buckets, and the first rows of a bucket also go to the end of the bucket before it.

    Defined cases: a null text is empty; empty texts have the fingerprint zero and are alike.
    A null id comes after all others. Rows of one id stand in the order of their texts. A
    single row is followed by itself. An empty table gives an empty table. Other columns are
    not read.
    """
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("_order"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = min(max(1, -(-size // config.bucket_bytes)), config.most_buckets)
    share = [i / wanted for i in range(1, wanted)]
    cuts = rows.agg(F.percentile_approx("_order", share, max(10_000, 100 * wanted))).first()[0] if share else []
    bounds = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def place(order: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, order.to_numpy(), side="right").astype(np.int32))

    placed = rows.withColumn("bucket", place("_order"))
    tops = placed.groupBy("bucket").agg(F.max("_order").alias("top")).orderBy("bucket").collect()  # a row per bucket
    # The largest ids of a bucket follow the smallest of the next bucket up; those of the last one start over.
    top = np.array([t.top for t in tops], np.int64)
    after = np.array([tops[(i + 1) % len(tops)].bucket for i in range(len(tops))], np.int32)

    @F.pandas_udf("int")
    def also(order: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(top, order.to_numpy()), len(top) - 1)
        return pd.Series(after[at]).where(pd.Series(top[at] == order.to_numpy())).astype("Int32")

    both = F.array(
        F.struct(F.col("bucket"), F.lit(False).alias("extra")),
        F.struct(also("_order").alias("bucket"), F.lit(True).alias("extra")),
    )
    goes = placed.withColumn("_to", F.explode(both)).filter(F.col("_to.bucket").isNotNull())
    goes = goes.select(F.col("_to.bucket").alias("bucket"), F.col("_to.extra").alias("extra"), "doc_id", "_order", "text")
    goes = goes.repartition(len(tops) or 1, "bucket").sortWithinPartitions("bucket", "extra", F.desc("_order"), "text")
    return goes.drop("_order").mapInArrow(lambda batches: _pairs(batches, config), COMPARED)
