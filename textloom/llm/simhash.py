"""SimHash near-duplicates, found by pigeonring filtering.

Two fingerprints that differ in at most ``budget`` bits are cut into ``boxes`` segments that
form a ring. The pigeonring principle: from some start on the ring, the differences summed
over the first 1, 2, 3, ... boxes all stay within ``floor(length * budget / boxes)``. With
more boxes than budget, the first box is equal there and the second may differ in a bit or
so. So every fingerprint is filed under each start with the bits of the first ``chain``
boxes, and once more under every variant that the budgets allow; two fingerprints within
the budget meet in a file. Longer chains are checked next, and the full Hamming
distance last.

A file's fingerprints are linked by search from one to the next among those not reached
yet, so a file of many near copies costs and gives about one link each, not all pairs.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import NO_ID_LAST, hex64, sorted_groups
from textloom.llm.components import connected
from textloom.storage import materialise

SEED = 42
# Fingerprint bits are counted for so many shingles at a time.
BLOCK = 65_536
# Files up to this size are compared by shifts over a whole batch, larger ones one by one.
SMALL_FILE = 16
# Hashes of shingles that a task holds before it passes them on.
HASHES = 1 << 21
# Shingles put last in the order of a prefix: at most so many, each in so many texts of a block or more.
FREQUENT, OFTEN = 100_000, 4
PARITY_BITS = 1024
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PigeonringConfig:
    """``chain`` boxes make up a key. A longer chain means fewer false candidates and more keys."""

    budget: int = 4
    boxes: int = 5
    chain: int = 2

    def __post_init__(self):
        if not self.budget < self.boxes <= 16 or not 1 <= self.chain <= self.boxes:
            raise ValueError("needs more boxes than budget and a chain of at most all boxes")

    def edges(self) -> list[int]:
        return [64 * i // self.boxes for i in range(self.boxes + 1)]

    def width(self, box: int) -> int:
        edges = self.edges()
        return edges[box % self.boxes + 1] - edges[box % self.boxes]

    def key_bits(self) -> int:
        """Room for the bits of a chain from any start; a key has the start above them."""
        return max(sum(self.width(start + i) for i in range(self.chain)) for start in range(self.boxes))

    def allowed(self, length: int) -> int:
        return length * self.budget // self.boxes

    def flips(self, start: int) -> list[int]:
        """All patterns of differing bits that a chain from ``start`` may have, 0 first."""
        patterns, offset = [0], self.width(start)
        for length in range(2, self.chain + 1):
            width = self.width(start + length - 1)
            longer = []
            for p in patterns:
                for k in range(self.allowed(length) - p.bit_count() + 1):
                    longer += [p | sum(1 << (offset + b) for b in bits) for bits in combinations(range(width), k)]
            patterns, offset = longer, offset + width
        return sorted(patterns, key=lambda p: (p.bit_count(), p))


def _majority(hashes: list[bytes]) -> bytes:
    """Bits set in over half of the hashes."""
    width = len(hashes[0])
    ones = np.zeros(8 * width, np.int64)
    for at in range(0, len(hashes), BLOCK):
        some = np.frombuffer(b"".join(hashes[at : at + BLOCK]), np.uint8).reshape(-1, width)
        ones += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


def shingles(found: list[bytes], words: int) -> Iterator[bytes]:
    """All runs of so many words, joined by one space; a shorter text is one shingle."""
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - words + 1)
    last = ends[np.minimum(np.arange(n) + words - 1, len(found) - 1)]
    return (joined[s:e] for s, e in zip(starts[:n].tolist(), last.tolist(), strict=True))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # on bytes: A-Z only, and the six blanks only


def fingerprint(text: bytes | None, words: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    found = words_of(text)
    if not found:
        return 0
    digest = xxhash.xxh64_digest
    return int.from_bytes(_majority([digest(s, SEED) for s in shingles(found, words)]), "big")


def word_fingerprints(text: bytes | None, seeds: int) -> list[int]:
    """64-bit SimHashes of the distinct words, one under each seed; zeros without words."""
    found = set(words_of(text))
    if not found:
        return [0] * seeds
    digest = xxhash.xxh64_digest
    bits = _majority([b"".join([digest(w, seed) for seed in range(seeds)]) for w in found])
    return [int.from_bytes(bits[8 * i : 8 * i + 8], "big") for i in range(seeds)]


def similarity_of(a: bytes | None, b: bytes | None, words: int) -> float:
    """Jaccard similarity of the shingle sets; 1 for two texts without words."""
    mine, theirs = (set(shingles(found, words)) if (found := words_of(t)) else set() for t in (a, b))
    return len(mine & theirs) / len(mine | theirs) if mine or theirs else 1.0


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4) -> DataFrame:
    """``(doc_id, fp)``; the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(text.as_py(), words) for text in batch.column(1))
            fps = np.fromiter(found, np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def filed(distinct: DataFrame, fingerprint_columns: list[str], config: PigeonringConfig) -> DataFrame:
    """``(key, node, fp, own)``: the files of every node under each of its fingerprints; ``own`` marks those of its own bits."""
    edges, room, files = config.edges(), config.key_bits(), []
    for part in range(len(fingerprint_columns)):
        for start in range(config.boxes):
            mask = (1 << sum(config.width(start + i) for i in range(config.chain))) - 1
            files += [(part, edges[start], mask, flip, (part << 4 | start) << room) for flip in config.flips(start)]
    fields = ("part", "at", "mask", "flip", "tag")
    kind = "array<struct<part:int,at:int,mask:long,flip:long,tag:long>>"
    listed = F.from_json(F.lit(json.dumps([dict(zip(fields, f, strict=True)) for f in files])), kind)
    rows = distinct.select("node", F.array(*fingerprint_columns).alias("fps"), F.explode(listed).alias("f"))
    rows = rows.select("node", F.get("fps", F.col("f.part")).alias("fp"), "f.*")
    turned = F.expr("shiftrightunsigned(fp, at) | shiftleft(fp, 64 - at)")  # by 64 bits is by none
    key = turned.bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip")).bitwiseOR(F.col("tag"))
    return rows.select(key.alias("key"), "node", "fp", (F.col("flip") == 0).alias("own"))


def _chained(differ: np.ndarray, start: np.ndarray, config: PigeonringConfig) -> np.ndarray:
    """Chains of growing length from the key's start, then the whole Hamming distance."""
    edges = config.edges()
    masks = np.array([((1 << config.width(i)) - 1) << edges[i] for i in range(config.boxes)], np.uint64)
    good, total = np.ones(len(differ), bool), np.zeros(len(differ), np.int64)
    for length in range(1, config.boxes + 1):
        total += np.bitwise_count(differ & masks[(start + length - 1) % config.boxes])
        good &= total <= config.allowed(length)
    return good & (np.bitwise_count(differ) <= config.budget)


def _middle(fps: np.ndarray) -> int:
    """The fingerprint nearest to the majority of all, by position: of edited copies it is the least edited."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1)
    majority = np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(fps)).view(np.uint64)
    return int(np.argmin(np.bitwise_count(fps ^ majority[0])))


def _search(fps: np.ndarray, config: PigeonringConfig) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links, as positions, that connect whatever is connected: each one is compared to those not reached yet."""
    left, links = np.arange(len(fps)), []
    while len(left):
        frontier = [int(left[_middle(fps[left])])]
        left = left[left != frontier[0]]
        while frontier and len(left):
            one = frontier.pop()
            near = np.bitwise_count(fps[left] ^ fps[one]) <= config.budget
            if near.any():
                links.append((np.full(int(near.sum()), one), left[near]))
                frontier += left[near].tolist()
                left = left[~near]
    return links


def _links(batches: Iterator[pa.RecordBatch], config: PigeonringConfig) -> Iterator[pa.RecordBatch]:
    for table in sorted_groups(batches, ["key"]):
        key, node = table.column("key").to_numpy(), table.column("node").to_numpy()
        fps, own = table.column("fp").to_numpy().view(np.uint64), table.column("own").to_numpy()
        start = (key >> config.key_bits()) & 15
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        # A file is of use only with someone's own bits in it.
        useful = (size > 1) & np.logical_or.reduceat(own, first)
        found = []
        small = np.flatnonzero(np.repeat(useful & (size <= SMALL_FILE), size))
        for shift in range(1, min(SMALL_FILE, len(small))):
            a, b = small[:-shift], small[shift:]
            met = (key[a] == key[b]) & (own[a] | own[b])
            a, b = a[met], b[met]
            if not len(a):
                break
            good = _chained(fps[a] ^ fps[b], start[a], config)
            found.append((a[good], b[good]))
        for at, n in zip(first[useful & (size > SMALL_FILE)], size[useful & (size > SMALL_FILE)], strict=True):
            distinct = at + np.unique(node[at : at + n], return_index=True)[1]
            found += [(distinct[a], distinct[b]) for a, b in _search(fps[distinct], config)]
        if found:
            pairs = np.sort(np.stack([node[np.concatenate(x)] for x in zip(*found, strict=True)], axis=1), axis=1)
            pairs = np.unique(pairs, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def near_links(distinct: DataFrame, fingerprint_columns: list[str], config: PigeonringConfig = PigeonringConfig()) -> DataFrame:
    """``(a, b)``: links that connect every two nodes of ``distinct(node, ...)`` with a fingerprint within the budget.

    Files grow with the number of distinct nodes only; the largest holds those around one
    fingerprint, 16 bytes each, and stays in the memory of a task.
    """
    placed = filed(distinct, fingerprint_columns, config).repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(lambda b: _links(b, config), "a long, b long")


def simhash_near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 4,
    config: PigeonringConfig = PigeonringConfig(),
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Defined cases: null, empty and blank texts have fingerprint zero and link like others;
    a text of fewer words than a shingle is one shingle. Rows of one id may have different
    fingerprints and keep their rows. Null ids keep their rows too; a component of null ids
    only has a null id. An empty table gives an empty table. Other columns are not read.
    """
    prints = materialise(fingerprints(documents, id_column, text_column, words), "fingerprints")
    # Equal fingerprints are one node from the start, so exact copies never meet in a file.
    distinct = prints.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("first"))
    distinct = materialise(distinct.withColumn("fp", F.col("node")), "distinct-fingerprints")
    labelled = _labelled(distinct, near_links(distinct, ["fp"], config))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = labelled.join(smallest, "label").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def _labelled(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """``distinct`` with the ``label`` of each node's component."""
    labelled = distinct.join(connected(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    return materialise(labelled, "labelled-nodes")


def _verified(links: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The links whose texts, ``texts(node, text)``, are as similar as that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("text"), batch.column("other"), strict=True)
            good = pa.array([similarity_of(x.as_py(), y.as_py(), words) >= similarity for x, y in sides], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    pairs = links.join(texts.toDF("a", "text"), "a").join(texts.toDF("b", "other"), "b")
    return pairs.mapInArrow(run, "a long, b long")


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; texts without words have one of their own."""
    found = words_of(text)
    if not found:
        return np.ones(1, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = max(1, len(found) - words + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(words, len(found))):
        out = (out ^ hashes[i : i + n]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _parity(hashes: np.ndarray) -> bytes:
    """Bits that each hash turns over one of: two sets differ in as many hashes as bits, or in more."""
    return np.packbits(np.bincount((hashes >> np.uint64(7)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1).tobytes()


def frequent_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of frequent shingles, sorted, and their ranks by frequency.

    They only say in which order a text's shingles are taken. Any order finds all pairs; this
    one keeps files small, so counts may leave out what is rare in a block of texts.
    """

    def counted(hashes: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(hashes), return_counts=True)
        often = n >= OFTEN
        return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], ["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = [], 0
        for batch in batches:
            for text in batch.column("text"):
                hashes.append(shingle_set(text.as_py(), words))
                total += len(hashes[-1])
                if total >= HASHES:
                    yield counted(hashes)
                    hashes, total = [], 0
        if hashes:
            yield counted(hashes)

    counts = texts.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    rank = np.empty(len(h), np.int64)
    rank[np.lexsort((h, n))] = np.arange(len(h))
    by_hash = np.argsort(h)
    return h[by_hash], rank[by_hash]


def _prefix(hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles in the common order: two sets as similar as that share one of them."""
    n = len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1
    if not len(frequent[0]):
        return hashes[:n]
    at = np.minimum(np.searchsorted(frequent[0], hashes), len(frequent[0]) - 1)
    known = frequent[0][at] == hashes
    rare = hashes[~known][:n]
    if len(rare) == n:
        return rare
    return np.concatenate([rare, hashes[known][np.argsort(frequent[1][at[known]])[: n - len(rare)]]])


def shared_prefixes(texts: DataFrame, words: int, similarity: float, hashes: int) -> DataFrame:
    """``(file, node)`` over ``texts(node, text)``: the nodes that share a shingle of their prefixes.

    Hashes travel packed, 12 bytes each. Files of the same nodes are one, so near copies, which
    share many shingles, meet once. Nodes may repeat. Buckets are made for so many ``hashes`` of all distinct texts.
    """
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, words))
    least = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(hashes * (1 - similarity) / HASHES))
    packed = np.dtype([("key", "<u4"), ("node", "<i8")])

    def packs(keys: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
        key = np.concatenate(keys)
        rows = np.empty(len(key), packed)
        rows["key"], rows["node"] = key & np.uint64(2**32 - 1), np.repeat(nodes, [len(k) for k in keys])
        bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        values = [r.tobytes() for r in np.split(rows[order], first[1:])]
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(values, pa.binary())], ["bucket", "packed"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seen, total = [], {}, 0
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                if node in seen:
                    continue
                seen[node] = None
                keys.append(_prefix(shingle_set(text.as_py(), words), frequent.value, similarity))
                total += len(keys[-1])
                if total >= HASHES:
                    yield packs(keys, list(seen))
                    keys, seen, total = [], {}, 0
        if keys:
            yield packs(keys, list(seen))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["bucket"]):
            rows = np.unique(np.frombuffer(b"".join(table.column("packed").to_pylist()), packed))
            new = np.concatenate(([True], rows["key"][1:] != rows["key"][:-1]))
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(rows)))
            node = rows["node"].view(np.int64) if rows["node"].flags.c_contiguous else rows["node"].copy()
            mixed = (node.view(np.uint64) ^ (node.view(np.uint64) >> np.uint64(31))) * MIX
            mixed ^= mixed >> np.uint64(29)
            file = np.repeat(np.add.reduceat(mixed * MIX, first), size).view(np.int64)
            several = np.repeat(size > 1, size)
            out = np.unique(np.stack([file[several], node[several]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["file", "node"])

    moved = texts.select("node", "text").mapInArrow(pack, "bucket int, packed binary")
    moved = moved.repartition("bucket").sortWithinPartitions("bucket")
    return moved.mapInArrow(meet, "file long, node long").distinct()


def _candidates(members: DataFrame, similarity: float, tree: bool) -> DataFrame:
    """``(a, b)`` of ``members(file, node, label, size, bits)``: pairs of a file, of different labels, that may be similar.

    Sizes and parities rule out only what cannot be. With ``tree``, a file's nodes are linked from
    one to the next among those not reached yet, else all its pairs come.
    """
    apart = (1 - similarity) / (1 + similarity)

    def pairs(label: np.ndarray, size: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        def may(one: int, others: np.ndarray) -> np.ndarray:
            low, high = np.minimum(size[others], size[one]), np.maximum(size[others], size[one])
            differ = np.bitwise_count(bits[others] ^ bits[one]).sum(axis=1, dtype=np.int64)
            return (low >= similarity * high - 1e-9) & (differ <= apart * (low + high) + 1e-9)

        left = np.arange(len(label))
        if not tree:
            for one in left:
                others = left[one + 1 :]
                others = others[label[others] != label[one]]
                yield int(one), others[may(one, others)]
            return
        while len(left):
            frontier, left = [int(left[0])], left[1:]
            while frontier and len(left):
                one = frontier.pop()
                same = label[left] == label[one]
                near = same | may(one, left)
                yield one, left[near & ~same]
                frontier += left[near].tolist()
                left = left[~near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["file"]):
            file, node, label, size = (table.column(c).to_numpy() for c in ("file", "node", "label", "size"))
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(file), -1)
            first = np.flatnonzero(np.concatenate(([True], file[1:] != file[:-1])))
            found, total = [], 0
            for low, high in zip(first, np.append(first[1:], len(file)), strict=True):
                for one, others in pairs(label[low:high], size[low:high], bits[low:high]):
                    if len(others):
                        found.append(np.sort(np.stack([np.full(len(others), node[low + one]), node[low + others]], axis=1), axis=1))
                        total += len(others)
                    if total >= HASHES:
                        yield _pair_batch(found)
                        found, total = [], 0
            if found:
                yield _pair_batch(found)

    several = members.groupBy("file").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high")
    members = members.join(several.select("file"), "file", "left_semi")
    return members.repartition("file").sortWithinPartitions("file").mapInArrow(run, "a long, b long").distinct()


def _pair_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def drop_near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    similarity: float = 0.8,
    seeds: int = 2,
    config: PigeonringConfig = PigeonringConfig(budget=6, boxes=7),
) -> DataFrame:
    """``documents`` with one row of each group of near-duplicates, the one of the smallest id.

    SimHashes of the distinct words under some ``seeds`` have files, and links between them
    count if the shingle sets are as similar as asked. That joins most near copies, dense
    groups by about one link each. The rest, such as copies with a block appended or replaced,
    whose words move a SimHash too far, and pairs whose file was linked by others that are not
    as similar, comes from an exact search: two texts as similar as asked share one of their
    rarest shingles (prefix filter). Texts that do, and are not in one group yet, are linked
    by a tree per file first and, where its links fail, by all remaining pairs; sizes and
    parities of the shingle sets rule out only what cannot be similar, and shingles decide.

    A text is known by 64 bits of its digest. Defined cases: texts without words are one
    group. Of equal ids the smaller text digest stays, of equal rows one. A null id comes
    last. An empty table gives an empty table. All columns stay, whatever their names.
    """
    text = F.col(text_column)
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID_LAST)).alias("doc_id"),
        F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
        text.cast("binary").alias("text"),
    ).withColumn("node", F.expr("cast(conv(substr(digest, 1, 16), 16, -10) as long)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            fps = np.array([word_fingerprints(t, seeds) for t in texts], np.uint64).reshape(-1, seeds)
            sets = ((len(s), _parity(s)) for s in (shingle_set(t, words) for t in texts))
            size, bits = zip(*sets, strict=True) if texts else ((), ())
            columns = [*(batch.column(c) for c in ("doc_id", "digest", "node")), pa.array(size, pa.int64()), pa.array(bits, pa.binary())]
            columns += map(pa.array, fps.view(np.int64).T.copy())
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "node", "size", "bits", *names])

    names = [f"fp{i}" for i in range(seeds)]
    kind = ", ".join(["doc_id long", "digest string", "node long", "size long", "bits binary", *(f"{n} long" for n in names)])
    prints = rows.select("doc_id", "digest", "node", "text").mapInArrow(run, kind)
    # A node is a text, under the smallest id that has it.
    distinct = prints.groupBy("digest", "node", "size", "bits", *names).agg(F.min("doc_id").alias("doc_id"))
    distinct = materialise(distinct, "distinct-texts")

    def verified(links: DataFrame) -> DataFrame:
        linked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        named = distinct.join(linked, "node").select("node", "doc_id", "digest")
        texts = rows.drop("node").join(named, ["doc_id", "digest"]).select("node", "text").dropDuplicates(["node"])
        return materialise(_verified(links, materialise(texts, "near-texts"), words, similarity), "similar-links")

    tested = materialise(near_links(distinct, names, config).distinct(), "near-links")
    similar = verified(tested)
    labelled = _labelled(distinct, similar)
    hashes = distinct.agg(F.sum("size")).first()[0] or 0
    files = materialise(shared_prefixes(rows, words, similarity, hashes), "prefix-files")
    for tree in (True, False):
        members = files.join(labelled.select("node", "label", "size", "bits"), "node")
        links = _candidates(members, similarity, tree).join(tested, ["a", "b"], "left_anti")
        links = materialise(links, "prefix-links")
        if not links.isEmpty():
            tested, similar = tested.union(links), similar.union(verified(links))
            labelled = _labelled(distinct, similar)
    stays = labelled.groupBy("label").agg(F.min(F.struct("doc_id", "digest")).alias("_stays")).select("_stays.*")
    kept = rows.select("row", "doc_id", "digest").join(stays, ["doc_id", "digest"], "left_semi")
    return kept.dropDuplicates(["doc_id", "digest"]).select("row.*")
