"""Substring dedup, decontamination, line dedup."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from textloom.llm.decontamination import LeakConfig, benchmark_spans, leaks_query, without_spans
from textloom.llm.fm_index import FMIndex
from textloom.llm.line_dedup import drop_repeated_lines
from textloom.llm.substring_dedup import SuperKmerConfig, remove_repeated_passages
from tests.llm.conftest import texts


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shared_passages(seed, n):
    rng, base = random.Random(seed), texts(seed, n)
    passages = texts(seed + 1, 5)
    out = []
    for t in base:
        words = t.split()
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages).split()
            at = rng.randrange(len(p))
            words[rng.randrange(len(words)) : 0] = p[at : at + rng.randrange(5, 40)]
        out.append(" ".join(words))
    return out + out[:5]


def brute_passages(pairs, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in pairs]
    order = [2**63 if i is None else i for i, _ in pairs]
    first = {}
    for o, w in zip(order, words, strict=True):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, o), o)
    out = []
    for (i, _), o, w in zip(pairs, order, words, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < o:
                gone.update(range(k, k + window))
        out.append((repr(i), len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out)


@pytest.mark.parametrize("config", [SuperKmerConfig(), SuperKmerConfig(chunk_words=60, bucket_bytes=700), SuperKmerConfig(gram=1, chunk_words=200)])
def test_passages_against_brute_force(make_docs, config):
    pairs = [(500 - k, t) for k, t in enumerate(shared_passages(2, 60))]
    got = remove_repeated_passages(make_docs(pairs).repartition(3), config=config)
    assert sorted((repr(r[0]), *r[1:]) for r in got.collect()) == brute_passages(pairs)


def test_passages_of_awkward_rows(make_docs, awkward):
    got = remove_repeated_passages(make_docs(awkward), keep_text=True).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_passages(awkward)
    assert all(sha(r.kept_text) == r.kept_sha256 for r in got)
    assert remove_repeated_passages(make_docs([])).collect() == []


def item_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_leaks(pairs, items, phrase=10):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for k in range(max(1, len(w) - phrase + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + phrase]), set()).add("null" if item is None else str(item))
    out = []
    for i, text in pairs:
        w, hit, named = item_words(text), set(), set()
        for window, names in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    named |= names
        out.append((repr(i), len(w), len(hit), len(named), sha(",".join(sorted(named))), bool(hit)))
    return sorted(out)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(k, t) for k, t in enumerate(texts(21, 6))] + [(2, "w1 w2 w3"), (None, "W5, w6!"), (40, None), (41, "?!"), (42, ""), (7, "w9")]
    return rows, spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS spans", "1 AS doc_id")


@pytest.mark.parametrize("config", [LeakConfig(), LeakConfig(shard_words=50, sample=3), LeakConfig(block_bytes=400)])
def test_leaks_against_brute_force(make_docs, items, config):
    rows, table = items
    rng, found = random.Random(4), texts(30, 30)
    for k in range(15):
        words, p = found[k].split(), rows[rng.randrange(6)][1].upper().split()
        at = rng.randrange(len(p) - 8)
        words[rng.randrange(len(words)) : 0] = p[at : at + rng.randrange(8, 40)]
        found[k] = "; ".join(words)
    pairs = [(k, t) for k, t in enumerate(found)] + [(3, found[3]), (3, "w1-w2 W3")]
    got = benchmark_spans(make_docs(pairs).repartition(2), table, config=config).collect()
    assert len(got) == len(pairs)
    told = [
        (repr(r.doc_id), r.n_words, sum(s.to_word - s.from_word for s in r.spans), len(r["items"]), sha(",".join(r["items"])), bool(r.spans))
        for r in got
    ]
    assert sorted(told) == brute_leaks(pairs, rows)
    for r in got:
        assert all(a.to_word < b.from_word for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_leaks_of_awkward_rows(spark, make_docs, awkward, items):
    rows, table = items
    got = leaks_query(make_docs(awkward), table).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == brute_leaks(awkward, rows)
    assert leaks_query(make_docs([]), table).collect() == []
    nothing = leaks_query(make_docs(awkward[:4]), table.limit(0)).collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in nothing] == [(0, 0, False)] * 4


def test_cutting_spans():
    assert without_spans("One, two; THREE four.", [(1, 3)]) == "One,  four."
    assert without_spans("One two", []) == "One two" and without_spans(None, [(0, 1)]) is None


@pytest.mark.parametrize("symbols,n", [(2, 1), (3, 40), (5, 300), (60, 500)])
def test_fm_index_counts_and_locates(symbols, n):
    rng = np.random.default_rng(n)
    text = np.append(rng.integers(1, symbols, n), 0)
    index = FMIndex(text, symbols, sample=4)
    patterns = np.zeros((50, 4), np.int64)
    lengths = rng.integers(1, 5, 50)
    for p, size in zip(patterns, lengths, strict=True):
        p[4 - size :] = rng.integers(1, symbols, size)
    low, high = index.search(patterns, lengths)
    for p, size, a, b in zip(patterns, lengths, low, high, strict=True):
        wanted = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p[4 - size :]).all()]
        assert sorted(index.locate(np.arange(a, b))) == wanted


def brute_lines(pairs, least=3, chars=20):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    order = [-(2**63) if i is None else i for i, _ in pairs]
    holders = {}
    for o, (_, t) in zip(order, pairs, strict=True):
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(o)
    out = []
    for o, (i, t) in zip(order, pairs, strict=True):
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= chars and len(holders[key(x)]) >= least and max(holders[key(x)]) != o for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((repr(i), len(lines), sum(gone), sha(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 7])
def test_lines_against_brute_force(make_docs, awkward, batches):
    rng = random.Random(6)
    pool = [f"  A Line that many documents hold {k}\t" for k in range(12)] + ["short", "", "exactly twenty chars"]
    pairs = [(k * 5, "\n".join(rng.choice(pool).swapcase() if rng.random() < 0.3 else rng.choice(pool) for _ in range(8))) for k in range(50)]
    pairs += [(k, f"own line of document number {k}\n" + pool[0]) for k in (1, 1, 2)] + awkward
    got = drop_repeated_lines(make_docs(pairs), batches=batches).collect()
    assert sorted((repr(r.doc_id), r.n_lines, r.n_dropped, sha(r.kept_text)) for r in got) == brute_lines(pairs)
    assert {r.row["digest"] for r in got} == {"other digest"}


def test_lines_of_an_empty_table(make_docs):
    assert drop_repeated_lines(make_docs([])).collect() == []


def test_rows_of_one_id_with_equal_short_hashes(spark):
    """Two texts that a 32-bit hash does not tell apart, under one id: only the one with the passage loses it."""
    from pyspark.sql import functions as F

    word = F.concat(F.lit("w"), F.col("id").cast("string"))
    candidates = spark.range(400_000).select(F.concat_ws(" ", *[F.concat(word, F.lit(f"v{k}")) for k in range(26)]).alias("text"))
    twins = candidates.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).filter(F.size("texts") > 1).first().texts
    rows = [(1, twins[0]), (2, twins[0]), (2, twins[1]), (None, twins[0]), (None, twins[1])]
    got = remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    # The rows without an id come after all others.
    assert sorted(((r.doc_id or 9), r.n_words, r.n_removed) for r in got.collect()) == [(1, 26, 0), (2, 26, 0), (2, 26, 26), (9, 26, 26), (9, 26, 26)]


def test_many_rows_without_an_id(make_docs):
    pairs = [(None if k % 3 else k, t) for k, t in enumerate(shared_passages(11, 300))]
    got = remove_repeated_passages(make_docs(pairs).repartition(4), config=SuperKmerConfig(chunk_words=400, bucket_bytes=3_000))
    assert sorted((repr(r[0]), *r[1:]) for r in got.collect()) == brute_passages(pairs)
