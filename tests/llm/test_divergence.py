"""Divergence of sources against dense counts in whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textloom.llm.divergence import DivergenceConfig, QuadTree, _walk, audit_divergence, shares

SCHEMA = "doc_id long, text string, lang string, source string, value string, term string, rank string"
BILLION = 10**9


def brute_force(rows, top: int) -> set[tuple]:
    documents, cells, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = Counter("".join(c.lower() if c < "\x80" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
        cells[lang, source].update(found)
        documents[lang].update(found.keys())
    out = set()

    def ranked(lang, source, part, values, most=None):
        for rank, (item, value) in enumerate(sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
            out.add((lang, source, part, item, value, rank))

    for lang in {g[0] for g in groups}:
        kept = [t for t, d in documents[lang].items() if d >= 3]
        sources = [s for g, s in groups if g == lang]
        total = {s: sum(cells[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + BILLION * (cells[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        whole = {t: 1 + BILLION * (sum(cells[lang, s][t] for s in sources) + 1) // (sum(total.values()) + len(kept)) for t in kept}
        for s in sources:
            ranked(lang, s, "pair", [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s])
            over = [(t, (p[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if cells[lang, s][t] and p[s][t] > whole[t]]
            ranked(lang, s, "term", over, top)
    return out


def some_documents(seed: int, n: int = 150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, source = rng.choice(("en", "en", "fr", None)), rng.choice(("a", "b", "c", "", None, "é", "hot", "hot", "hot"))
        words = [f"w{chr(97 + min(25, int(rng.expovariate(0.2))))}{'é' * rng.randrange(2)}" for _ in range(rng.randrange(40))]
        own = [f"own{source}"] * rng.randrange(4) + [f"rare{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"]
        rows.append((i, " ".join(words + own), lang, source, "x", "y", "z"))
    rows += [(1, None, "xx", "none", *"xyz"), (1, "", "xx", "empty", *"xyz"), (2, "alone", "xx", "none", *"xyz")]
    rows += [(None, None, "en", "silent", *"xyz"), (5, "term " * 30_000 + "x" * 50_000, "yy", "a", *"xyz")] * 3
    return rows


@pytest.mark.parametrize(("strip_cells", "tile_groups", "top"), [(1 << 16, 512, 200), (16, 3, 5)])
def test_dense_counts(spark, strip_cells, tile_groups, top):
    """Strips of a few terms and tiles of a few groups give what one tree of all gives."""
    rows = some_documents(top)
    config = DivergenceConfig(strip_cells=strip_cells, tile_groups=tile_groups, top_terms=top)
    got = audit_divergence(spark.createDataFrame(rows, SCHEMA), config=config)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_force(rows, top)


def test_empty(spark):
    assert audit_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_beyond_64_bits():
    counts = np.array([0, 12 * BILLION])
    assert shares(counts, np.array([12 * BILLION] * 2), 2).tolist() == [1, 1 + BILLION * (12 * BILLION + 1) // (12 * BILLION + 2)]


@pytest.mark.parametrize("size", [(1, 1, 1), (3, 5, 17), (9, 2, 4)])
def test_walk_visits_each_cell_once(size):
    """Leaves and priced quadrants together are all cells of all pairs of rows."""
    rng = np.random.default_rng(sum(size))
    height = max(1, int(max(size) - 1).bit_length())
    dense = [rng.random((n, size[2])) < 0.2 for n in size[:2]]
    trees = [QuadTree(*np.nonzero(d), height) for d in dense]
    seen = np.zeros(size, int)
    for level, found, widths in _walk(*trees, size):
        if widths is None:
            a, b, c, na, nb = found
            np.add.at(seen, (a, b, c), 1)
            assert ((na >= 0) == dense[0][a, c]).all() and ((nb >= 0) == dense[1][b, c]).all() and ((na >= 0) | (nb >= 0)).all()
        else:
            side = 1 << (height - level)
            for a, b, w in zip(*found, widths, strict=True):
                rows, columns = slice(a * side, (a + 1) * side), slice(b * side, (b + 1) * side)
                priced = ~(dense[0][rows, None, :].any(axis=(0, 1)) | dense[1][columns, None, :].any(axis=(0, 1)))
                assert priced.sum() >= w
    occupied = (dense[0][:, None, :] | dense[1][None, :, :]).astype(int)
    assert (seen == occupied).all()
