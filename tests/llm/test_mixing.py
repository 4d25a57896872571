from __future__ import annotations

import random
import re

import pytest

from textloom.llm.mixing import MixtureConfig, mix_sources, mixing_query, taken_words
from tests.llm.conftest import texts


def brute_targets(sizes, share=1.5, repeats=2):
    """Share by weight; give what is above the most to the others until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if each[s] >= repeats * sizes[s]]
        if not above:
            return {**full, **each}
        for s in above:
            full[s] = repeats * sizes[s]
            left -= full[s]
        if len(full) == len(order):
            return full


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("config", [MixtureConfig(min_slot_bits=8, max_block=16, rows_per_part=7), MixtureConfig()])
def test_targets_and_taken_words(make_docs, awkward, config):
    rng = random.Random(3)
    pairs = [(k, t) for k, t in enumerate(texts(11, 150))] + awkward[:8] + awkward[10:]
    sources = [rng.choice(["hot", "hot", "é", "B", "a", None, "zz"]) for _ in pairs]
    docs = make_docs(pairs, sources=sources)
    mixture = mix_sources(docs, config=config)
    rows = taken_words(mixture).collect()
    assert len(rows) == len(pairs)
    sizes = {}
    for (_, t), s in zip(pairs, sources, strict=True):
        sizes[s] = sizes.get(s, 0) + size_of(t)
    targets = brute_targets(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = taken_words(mix_sources(docs.repartition(5), config=config)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    # Any stretch of the schedule holds the sources in their shares, but for a few blocks.
    pieces = sorted((p.slot, p.source or "", p.words) for p in mixture.pieces.collect())
    total = sum(w for _, _, w in pieces)
    half, at = {}, 0
    for _, s, w in pieces:
        if at < total / 2:
            half[s] = half.get(s, 0) + w
        at += w
    block = max(w for _, _, w in pieces)
    for s, words in half.items():
        assert abs(words - targets[s or None] / 2) <= 10 * block + 0.02 * total


def test_nothing_to_mix(make_docs):
    assert mixing_query(make_docs([])).collect() == []
    rows = mixing_query(make_docs([(1, None), (2, " "), (None, "")])).collect()
    assert [(r["size"], r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 3
