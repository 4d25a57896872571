"""Source divergence audit over a k2-tree of group-term counts.

A group is a source within a language. The counts of a language's terms by group are a matrix with
mostly empty cells, cut into strips of terms. A strip becomes a quadtree (k = 2) that stores four
bits per occupied quadrant and the counts at its leaves. Two groups are compared by walking their
rows through the tree together: where both rows' quadrants are empty, every term costs the
same, so the quadrant is priced by its width and not entered; what is left are the terms
that one of the two groups has. All pairs of a strip walk at once, as arrays.

Probabilities are whole parts of a billion, and all numbers are integers.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import LOWER, UPPER
from textloom.storage import materialise

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
# Cells that a task counts before it sends them on.
REMEMBERED = 400_000
BILLION = 1_000_000_000
# Triples of two groups and a quadrant that are taken apart at once.
WALKED = 1 << 16
COUNTED = "lang string, source string, term string, n long, docs long"
PRICED = "lang string, source string, part string, item string, value long"


@dataclass(frozen=True)
class DivergenceConfig:
    """Terms of ``min_documents`` documents of a language are kept; ``top_terms`` are reported per group. A strip holds about
    ``strip_cells`` counts and a task ``tile_groups`` groups a side; both are sizes of work and change no result."""

    min_documents: int = 3
    top_terms: int = 200
    strip_cells: int = 1 << 16
    tile_groups: int = 512


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], dict[str, list[int]]] = defaultdict(dict)
    held = 0

    def flushed() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), terms in counts.items():
            columns[0] += [lang] * len(terms)
            columns[1] += [source] * len(terms)
            columns[2] += terms.keys()
            columns[3] += [n for n, _ in terms.values()]
            columns[4] += [docs for _, docs in terms.values()]
        counts.clear()
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text")), strict=True):
            terms = counts[lang.as_py(), source.as_py()]
            before = len(terms)
            for term, n in Counter(TERM.findall(text.as_py().translate(LOWERED).decode("utf-8", "replace"))).items():
                seen = terms.get(term)
                if seen is None:
                    terms[term] = [n, 1]
                else:
                    seen[0] += n
                    seen[1] += 1
            held += len(terms) - before
            if held >= REMEMBERED:
                yield flushed()
                held = 0
    yield flushed()


def group_terms(documents: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` out of ``documents(text, lang, source)``: occurrences, and documents with the term."""
    rows = documents.select("lang", "source", F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(_counted, COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class QuadTree:
    """A k2-tree (k = 2): ``bits[level]`` has four bits per occupied quadrant, one for each of its quarters, and
    ``rank[level]`` the number of a quarter among the occupied ones, which is its place on the next level."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, height: int):
        self.height = height
        code = np.zeros(len(rows), np.int64)
        for bit in range(height):
            code |= ((rows >> bit & 1) << (2 * bit + 1)) | ((columns >> bit & 1) << (2 * bit))
        self.order = np.argsort(code, kind="stable")
        code = code[self.order]
        self.bits, self.rank = [], []
        for level in range(height):
            children = np.unique(code >> 2 * (height - level - 1))
            _, parent = np.unique(children >> 2, return_inverse=True)
            bits = np.zeros(4 * (parent[-1] + 1 if len(parent) else 1), bool)
            bits[4 * parent + (children & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)

    def quarter(self, level: int, node: np.ndarray, row_bit: int, column_bit: int) -> np.ndarray:
        """The node on the next level, -1 for an empty one and for the quarters of an empty one."""
        at = 4 * np.maximum(node, 0) + (2 * row_bit + column_bit)
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


def _walk(a: QuadTree, b: QuadTree, sizes: tuple[int, int, int]) -> Iterator[tuple[int, tuple[np.ndarray, ...] | None, np.ndarray | None]]:
    """All pairs of a row of ``a`` and a row of ``b`` through the same columns.

    Yields ``(level, (row blocks of a, of b), widths)`` for quadrants empty in both, and for leaves ``(height,
    (row of a, row of b, column, leaf of a, leaf of b), None)`` where one of the two is occupied, -1 for the other.
    """
    height = a.height
    start = np.zeros(1, np.int64)
    # An empty tree has no occupied quarter, so its root stands like any other.
    stack = [(0, (start, start, start, start, start))]
    while stack:
        level, (ra, rb, c, na, nb) = stack.pop()
        if level == height:
            yield level, (ra, rb, c, na, nb), None
            continue
        if len(ra) > WALKED:
            half = len(ra) // 2
            stack.append((level, tuple(x[:half] for x in (ra, rb, c, na, nb))))
            stack.append((level, tuple(x[half:] for x in (ra, rb, c, na, nb))))
            continue
        side = height - level - 1
        parts = []
        for column_bit in (0, 1):
            child_c = 2 * c + column_bit
            for a_bit in (0, 1):
                child_a, node_a = 2 * ra + a_bit, a.quarter(level, na, a_bit, column_bit)
                for b_bit in (0, 1):
                    child_b, node_b = 2 * rb + b_bit, b.quarter(level, nb, b_bit, column_bit)
                    inside = (child_a << side < sizes[0]) & (child_b << side < sizes[1]) & (child_c << side < sizes[2])
                    empty = inside & (node_a < 0) & (node_b < 0)
                    if empty.any():
                        first = child_c[empty] << side
                        yield level + 1, (child_a[empty], child_b[empty]), np.minimum(first + (1 << side), sizes[2]) - first
                    full = inside & ~empty
                    if full.any():
                        parts.append(tuple(x[full] for x in (child_a, child_b, child_c, node_a, node_b)))
        if parts:
            stack.append((level + 1, tuple(np.concatenate(x) for x in zip(*parts, strict=True))))


def shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """Parts of a billion, with one added to every count."""
    counts, totals = counts + 1, totals + terms
    if len(counts) and int(counts.max()) > 2**63 // BILLION - 1:  # the product leaves 64 bits
        return (1 + BILLION * counts.astype(object) // totals).astype(np.int64)
    return 1 + BILLION * counts // totals


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _strip(rows: pd.DataFrame, config: DivergenceConfig) -> pd.DataFrame:
    """Values of a strip for the groups of one tile against those of another: rows are groups (``term`` is null, ``total``
    their count) and cells; ``terms`` is the language's number of terms and ``lang_total`` its count, ``strip_terms``
    the strip's number of terms, some of which neither tile may have."""
    lang, terms, lang_total = rows.lang.iat[0], int(rows.terms.iat[0]), int(rows.lang_total.iat[0])
    cells = rows[rows.term.notna()]
    # Terms of the same groups stand side by side, which leaves large empty quadrants.
    place_of = {term: i for i, term in enumerate(sorted(set(cells.term)))}
    held = cells.groupby("term", sort=True).source.agg(lambda s: tuple(sorted(s)))
    column_of = {term: i for i, term in enumerate(sorted(place_of, key=lambda t: (held[t], t)))}
    width = len(place_of)

    def side(flag: str):
        own = rows[rows[flag]]
        groups = own[own.term.isna()].sort_values("source")
        sources, totals = groups.source.to_numpy(object), groups.total.to_numpy(np.int64)
        row_of = {s: i for i, s in enumerate(sources)}
        mine = own[own.term.notna()]
        r = np.fromiter((row_of[s] for s in mine.source), np.int64, len(mine))
        c = np.fromiter((column_of[t] for t in mine.term), np.int64, len(mine))
        n, lang_n = mine.n.to_numpy(np.int64), mine.lang_n.to_numpy(np.int64)
        return sources, totals, r, c, shares(n, totals[r], terms), lang_n, mine.term.to_numpy(object)

    a, b = side("as_a"), side("as_b")
    same = bool(rows.as_a.eq(rows.as_b).all())
    height = max(1, int(max(len(a[0]), len(b[0]), width) - 1).bit_length())
    tree_a = QuadTree(a[2], a[3], height)
    tree_b = tree_a if same else QuadTree(b[2], b[3], height)
    zero = np.zeros(1, np.int64)
    zero_a, zero_b = (shares(np.zeros_like(t), t, terms) if terms else zero.repeat(len(t)) for t in (a[1], b[1]))
    p_leaf, q_leaf = (np.append(x[4][tree.order], 1) for x, tree in ((a, tree_a), (b, tree_b)))  # -1 has no leaf
    size_a, size_b = len(a[0]), len(b[0])
    values = np.zeros(size_a * size_b, np.int64)
    blank = np.full((size_a, size_b), int(rows.strip_terms.max()) - width)
    if width:
        empty = [np.zeros((-(-size_a >> height - lv) + 1, -(-size_b >> height - lv) + 1), np.int64) for lv in range(height + 1)]
        for level, found, widths in _walk(tree_a, tree_b, (size_a, size_b, width)):
            if widths is not None:
                np.add.at(empty[level], found, widths)
                continue
            ra, rb, _, na, nb = found
            p = np.where(na >= 0, p_leaf[na], zero_a[ra])
            q = np.where(nb >= 0, q_leaf[nb], zero_b[rb])
            np.add.at(values, ra * size_b + rb, price(p, q))
        for level, table in enumerate(empty):
            blank += table[np.arange(size_a)[:, None] >> height - level, np.arange(size_b)[None, :] >> height - level]
    values += (blank * price(zero_a[:, None], zero_b[None, :])).ravel()
    out = [[], [], [], []]
    others = (a[0][:, None] != b[0][None, :]).ravel()
    out[0] = np.repeat(a[0], size_b)[others].tolist()
    out[1] = ["pair"] * len(out[0])
    out[2] = np.tile(b[0], size_a)[others].tolist()
    out[3] = values[others].tolist()
    if same:
        # The leaves of a group against the language: the strip's best stand for all its terms.
        q = shares(a[5], np.array([lang_total]), terms)
        over = np.flatnonzero(a[4] > q)
        value = price(a[4][over], q[over])
        place = np.fromiter((place_of[t] for t in a[6][over]), np.int64, len(over))
        by = np.lexsort((place, -value, a[2][over]))
        row = a[2][over][by]
        first = np.searchsorted(row, row)
        best = by[np.arange(len(by)) - first < config.top_terms]
        out[0] += a[0][a[2][over[best]]].tolist()
        out[1] += ["term"] * len(best)
        out[2] += a[6][over[best]].tolist()
        out[3] += value[best].tolist()
    frame = pd.DataFrame({"lang": lang, "source": out[0], "part": out[1], "item": out[2], "value": out[3]})
    return frame.astype(dict.fromkeys(("lang", "source", "part", "item"), object) | {"value": np.int64})


def audit_divergence(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    config: DivergenceConfig = DivergenceConfig(),
) -> DataFrame:
    """How far the term shares of each source of a language are from those of every other source, and its most peculiar terms.

    ``(lang, source, part, item, value, rank)``: part ``pair`` has a row for each other source of the
    language, part ``term`` the best ``top_terms`` terms that a source has more of than its language.
    Values are whole numbers, ranks go down by value, ties by item.

    Defined cases: null texts, languages and sources are empty strings, and such a
    language or source is one like any other. A group without terms is compared to the others. A language without
    kept terms has pairs of value 0. A language with one source has no pairs. Equal rows are documents each;
    ids are not read. An empty table gives an empty table. Other columns are not read.
    """
    columns = {"text": text_column, "lang": lang_column, "source": source_column}
    texts = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in columns.items()])
    counted = materialise(group_terms(texts), "group-terms")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs"))
    kept = materialise(kept.filter(F.col("_docs") >= config.min_documents).drop("_docs"), "kept-terms")
    cells = materialise(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "group-cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("_cells"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total", "_cells"])
    groups = materialise(groups, "groups")
    # One row per language from here on.
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("_cells").alias("_cells"), F.count(F.lit(1)).alias("_groups")
    ).join(sizes, "lang", "left")
    langs = materialise(
        langs.select(
            "lang", "lang_total", F.coalesce("terms", F.lit(0)).cast("long").alias("terms"),
            F.greatest(F.lit(1), F.ceil(F.col("_cells") / config.strip_cells)).cast("int").alias("_strips"),
            F.greatest(F.lit(1), F.ceil(F.col("_groups") / config.tile_groups)).cast("int").alias("_tiles"),
        ),
        "languages",
    )

    def listed(size: str):
        return F.sequence(F.lit(0), F.col(size) - 1)

    strip = F.pmod(F.xxhash64("term"), F.col("_strips")).cast("int")
    strips = kept.join(langs, "lang").groupBy("lang", strip.alias("strip")).agg(F.count(F.lit(1)).alias("strip_terms"))
    as_groups = groups.join(langs, "lang").withColumn("strip", F.explode(listed("_strips")))
    as_groups = as_groups.join(strips, ["lang", "strip"], "left").fillna(0, ["strip_terms"])
    zero = F.lit(0).cast("long")
    as_groups = as_groups.withColumns({"term": F.lit(None).cast("string"), "n": zero, "lang_n": zero})
    as_cells = cells.join(langs, "lang").withColumns({"strip": strip, "total": zero, "strip_terms": zero})
    used = ["lang", "lang_total", "terms", "_tiles", "strip", "strip_terms", "source", "term", "n", "lang_n", "total"]
    own = F.pmod(F.xxhash64("source"), F.col("_tiles")).cast("int")

    def tile(i, j, as_a, as_b):
        return F.struct(i.alias("i"), j.alias("j"), as_a.alias("as_a"), as_b.alias("as_b"))

    rows_of = F.transform(listed("_tiles"), lambda j: tile(own, j, F.lit(True), j == own))
    columns_of = F.transform(F.filter(listed("_tiles"), lambda i: i != own), lambda i: tile(i, own, F.lit(False), F.lit(True)))
    both = as_groups.select(*used).unionByName(as_cells.select(*used))
    tiled = both.select(*[c for c in used if c != "_tiles"], F.inline(F.concat(rows_of, columns_of)))
    priced = tiled.groupBy("lang", "strip", "i", "j").applyInPandas(lambda rows: _strip(rows, config), PRICED)
    priced = materialise(priced, "strip-values")
    pairs = priced.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    best = priced.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= config.top_terms)
    return pairs.withColumn("rank", rank).unionByName(best).select("lang", "source", "part", "item", "value", "rank")


DIVERGENCE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
found AS (
  SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM texts),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cells AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS whole
  FROM groups g JOIN langs l USING (lang) JOIN kept k ON k.lang = g.lang
  LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - whole) * (p - whole) // whole)::BIGINT FROM p WHERE n > 0 AND p > whole),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM valued)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
