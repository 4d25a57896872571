"""TF-IDF over word n-grams: smooth idf, sublinear tf, unit length.

Counting terms happens inside the row (see ``functions.text.term_counts``), so
fitting shuffles partial counts per term only. Scoring folds the length into its
own aggregate and needs no normalised features at all; see ``operators.scoring``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.columns import DEFAULT_COLUMNS, Columns
from textloom.functions.text import cleaned_term_counts, tokens
from textloom.sizing import MAX_BROADCAST_BYTES, SALTS, skew_safe_lookup
from textloom.storage import materialise, new_path, release


# Counted terms of a document, where a table brings them along; see ``operators.term_statistics``.
COUNTS = "Term_Counts"
KNOWN, PIECE, ASKED = "_known", "_piece", "_asked"
# Counted terms on their way to a piece: as one text, which weighs a fraction of an array of pairs, and their numbers.
TERMS, TIMES, BETWEEN = "_terms", "_times", "\n"
# Terms of the documents of a piece: what a task of a lookup has at once, some 100 MB in Python.
PIECE_TERMS = 1_000_000
# Words that a task counts at once: some 200 MB in Python.
BATCH_WORDS = 2_000_000
# Text whose term rows one task sorts by document, and the text behind a counted term.
DOCUMENT_TEXT_BYTES, TERM_TEXT_BYTES = 2 * 1024 * 1024, 3


@dataclass(frozen=True)
class TfidfConfig:
    """An ``int`` document-frequency bound counts documents, a ``float`` is a fraction of them."""

    ngram_range: tuple[int, int] = (1, 2)
    min_df: int | float = 2
    max_df: int | float = 1.0
    sublinear_tf: bool = True
    use_idf: bool = True
    max_features: int | None = None

    def __post_init__(self) -> None:
        low, high = self.ngram_range
        if not 1 <= low <= high:
            raise ValueError("ngram_range must satisfy 1 <= low <= high")

    def as_dict(self) -> dict:
        return asdict(self)

    def term_weight(self, tf: Column | None = None) -> Column:
        tf = F.col("tf") if tf is None else tf
        return 1 + F.log(tf) if self.sublinear_tf else tf.cast("double")

    def idf(self, n_docs: int) -> Column:
        """Smooth idf from the ``df`` column: ``ln((1 + n) / (1 + df)) + 1``."""
        return F.log((1.0 + n_docs) / (1 + F.col("df"))) + 1 if self.use_idf else F.lit(1.0)


def term_rows(df: DataFrame, config: TfidfConfig, columns: Columns, keep: list[str] = (), outer: bool = False) -> DataFrame:
    """One row per document and distinct term: id, ``keep``, ``term``, ``tf``.

    With ``outer`` a document without any term stays as one row with a NULL term.
    """
    counts = term_counts_of(df, config, columns)
    rows = F.inline_outer(counts) if outer else F.inline(counts)
    return df.select(columns.id, *keep, rows)


def term_counts_of(df: DataFrame, config: TfidfConfig, columns: Columns) -> Column:
    """The terms of each document with their counts: as stored, or else out of the cleaned text."""
    return F.col(COUNTS) if COUNTS in df.columns else cleaned_term_counts(F.col(columns.cleaned), *config.ngram_range)


def content_column(df: DataFrame, columns: Columns) -> str:
    """What terms are made of."""
    return COUNTS if COUNTS in df.columns else columns.cleaned


def _absolute(bound: int | float, n_docs: int) -> float:
    return bound * n_docs if isinstance(bound, float) else bound


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary ``term, df, tf, idf`` and the number of documents behind it."""

    config: TfidfConfig
    columns: Columns
    vocabulary: DataFrame
    n_docs: int
    n_terms: int

    def weighted(self, df: DataFrame, keep: list[str] = (), outer: bool = False) -> DataFrame:
        """Known terms of every document with their weight ``raw`` before length scaling."""
        table = self.vocabulary.select("term", "df", "idf")
        looked_up = known_rows(df, table, self.config, self.columns, keep, outer)
        return looked_up.withColumn("raw", self.config.term_weight() * F.col("idf"))

    def transform(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        """Features as a long table: id, ``keep``, ``term``, ``tf``, ``tfidf``.

        Documents are spread by id first: moving a text is cheaper than moving
        its terms, and the length of a document is then known where its terms are.
        A vocabulary that is not broadcast comes to the documents, whose rows then have their lengths in themselves.
        """
        if not travels(table := self.vocabulary.select("term", "df", "idf")):
            return self._transform_in_pieces(df, table, list(keep))
        placed = by_document(df, self.columns, keep)
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(self.columns.id)))
        return self.weighted(placed, keep).select(
            self.columns.id, *keep, "term", "tf", (F.col("raw") / length).alias("tfidf"), "df"
        )

    def _transform_in_pieces(self, df: DataFrame, table: DataFrame, keep: list[str]) -> DataFrame:
        counts = stored_counts(df, self.config, self.columns, keep)
        known = known_documents(counts, table, self.columns, keep)

        def raw(t: Column) -> Column:
            return self.config.term_weight(t["tf"]) * t["idf"]

        squares = F.aggregate(KNOWN, F.lit(0.0), lambda total, t: total + raw(t) * raw(t))
        if ids_repeat(counts, self.columns):  # rows of one id are one document
            lengths = known.groupBy(self.columns.id).agg(F.sqrt(F.sum(squares)).alias("_length"))
            same = F.col(self.columns.id).eqNullSafe(F.col("_id"))
            known = known.join(lengths.withColumnRenamed(self.columns.id, "_id"), same).drop("_id")
        else:
            known = known.withColumn("_length", F.sqrt(squares))
        rows = known.select(self.columns.id, *keep, "_length", F.inline(KNOWN))
        tfidf = self.config.term_weight() * F.col("idf") / F.col("_length")
        return rows.select(self.columns.id, *keep, "term", "tf", tfidf.alias("tfidf"), "df")

    def indexed_vocabulary(self) -> DataFrame:
        """The vocabulary with ``idx``: the position of the term in code-point order."""
        return with_sorted_position(self.vocabulary, "idx", F.asc("term"))

    def vectors(self, df: DataFrame, indexed: DataFrame, keep: list[str] = ()) -> DataFrame:
        """Features as Spark ML sparse vectors: id, ``keep``, ``features``.

        The vector's parts are written as plain columns and read back as vectors,
        which gives ML training a stored input and keeps Python out.
        """
        placed = by_document(df, self.columns, keep)
        terms = known_rows(
            placed, indexed.select("term", "df", "idf", "idx"), self.config, self.columns, keep, outer=True
        ).withColumn("raw", self.config.term_weight() * F.col("idf"))
        known = F.when(F.col("idx").isNotNull(), F.struct("idx", "raw"))
        documents = terms.groupBy(self.columns.id, *keep).agg(
            F.sort_array(F.collect_list(known)).alias("entries"),
            F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"),
        )
        parts = F.struct(
            F.lit(0).cast("byte").alias("type"),
            F.lit(self.n_terms).cast("int").alias("size"),
            F.transform("entries.idx", lambda i: i.cast("int")).alias("indices"),
            F.transform(F.col("entries.raw"), lambda x: x / F.col("length")).alias("values"),
        )
        written = documents.select(self.columns.id, *keep, parts.alias("features"))
        path = new_path(df.sparkSession, "features")
        written.write.parquet(path)
        fields = [f for f in written.schema.fields if f.name != "features"]
        schema = T.StructType([*fields, T.StructField("features", VectorUDT())])
        return df.sparkSession.read.schema(schema).parquet(path)


def by_document(df: DataFrame, columns: Columns, keep: list[str] = ()) -> DataFrame:
    """Id, ``keep`` and content, spread by id into pieces of ``DOCUMENT_TEXT_BYTES`` of text. The number is given, as merged
    partitions would hold the more text the larger the table is, and their terms are sorted in one task."""
    content = content_column(df, columns)
    if content == COUNTS:
        size = F.size(COUNTS) * TERM_TEXT_BYTES
    else:  # texts are about as long as cleaned ones and need no cleaning to be measured
        size = F.octet_length(columns.text if columns.text in df.columns else content)
    total = df.agg(F.sum(F.coalesce(size, F.lit(0)).cast("long"))).first()[0] or 0
    pieces = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total / DOCUMENT_TEXT_BYTES))
    return df.select(columns.id, *keep, content).repartition(pieces, columns.id)


def lookup_terms(
    terms: DataFrame, table: DataFrame, outer: bool, max_bytes: int | None = None, salts: int = SALTS
) -> DataFrame:
    """Join rows of terms to a per-term table.

    Up to ``max_bytes``, as measured, the table travels to every executor. A larger one is
    joined by shuffle, with frequent terms split; :func:`known_rows` moves far less where documents are at hand.
    """
    how = "left" if outer else "inner"
    if travels(table, max_bytes):
        return terms.join(F.broadcast(table), "term", how)
    return skew_safe_lookup(terms, table, "term", how, salts)


def travels(table: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a per-term table is small enough to be sent to every executor."""
    return table_bytes(table) <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes)


def known_rows(
    df: DataFrame, table: DataFrame, config: TfidfConfig, columns: Columns, keep: list[str] = (), outer: bool = False
) -> DataFrame:
    """The documents' terms that a per-term table knows: id, ``keep``, ``term``, ``tf`` and the table's columns.

    With ``outer`` a document without any known term stays as one row or more without them. A table that is too large
    to travel is looked up by :func:`known_documents`.
    """
    keep = list(keep)
    if travels(table):
        rows = term_rows(df, config, columns, keep, outer)
        return rows.join(F.broadcast(table), "term", "left" if outer else "inner")
    known = known_documents(stored_counts(df, config, columns, keep), table, columns, keep)
    return known.select(columns.id, *keep, F.inline_outer(KNOWN) if outer else F.inline(KNOWN))


def stored_counts(df: DataFrame, config: TfidfConfig, columns: Columns, keep: list[str]) -> DataFrame:
    """The documents with their terms counted, stored if they do not bring them along: id, ``keep``, counts."""
    counts = df.select(columns.id, *keep, term_counts_of(df, config, columns).alias(COUNTS))
    if COUNTS in df.columns:
        return counts
    stored = materialise(counts, "counted")
    release(df.sparkSession)
    return stored


def ids_repeat(df: DataFrame, columns: Columns) -> bool:
    return not df.groupBy(columns.id).count().filter(F.col("count") > 1).isEmpty()


def known_documents(counts: DataFrame, table: DataFrame, columns: Columns, keep: list[str]) -> DataFrame:
    """Counted documents with the terms that a large per-term table knows: id, ``keep`` and ``_known``, an array of
    ``(term, tf, ...)`` with the table's columns.

    Documents are dealt to pieces of bounded size. A piece asks for each of its distinct terms once, so a term is asked for
    as often as there are pieces, however frequent it is, and the table moves once. The answers come back to the
    piece. What is shuffled are texts and the distinct terms of pieces, never a row per document and term.
    """
    total = counts.agg(F.sum(F.size(COUNTS))).first()[0] or 0
    pieces = max(counts.sparkSession.sparkContext.defaultParallelism, math.ceil(total / PIECE_TERMS))
    # Rows of one id, or of none, are told apart by their terms.
    key = F.xxhash64(columns.id, COUNTS) if ids_repeat(counts, columns) else F.xxhash64(columns.id)
    terms = F.array_join(F.transform(COUNTS, lambda t: t["term"]), BETWEEN)  # terms are words and blanks
    packed = [F.when(F.size(COUNTS) > 0, terms).alias(TERMS), F.transform(COUNTS, lambda t: t["tf"]).alias(TIMES)]
    piece = F.pmod(key, F.lit(pieces)).cast("int").alias(PIECE)
    dealt = counts.select(columns.id, *keep, *packed, piece).repartition(pieces, PIECE)
    # All columns of the documents go into this function, so their shuffle is the same as that for the answers and is made once.
    wanted = dealt.mapInArrow(_asked, f"{ASKED} int, term string")
    answers = wanted.join(table, "term").repartition(pieces, ASKED)
    # Arrow tells types that hold nulls from those that do not; names of types leave them open.
    kinds = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in table.dtypes if name != "term"]
    entry = T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType()), *kinds])
    kept = [f for f in counts.schema.fields if f.name != COUNTS]
    schema = T.StructType([*kept, T.StructField(KNOWN, T.ArrayType(entry))])
    attach = _attached([f.name for f in kept], [f.name for f in kinds])
    return dealt.groupBy(PIECE).cogroup(answers.groupBy(ASKED)).applyInArrow(attach, schema)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of every piece; a partition holds whole pieces."""
    held: dict[int, list[pa.Array]] = {}
    grown: dict[int, int] = {}
    for batch in batches:
        texts, of = batch.column(TERMS), batch.column(PIECE)
        for piece in of.unique().to_pylist():
            terms = pc.split_pattern(texts.filter(pc.equal(of, piece)), BETWEEN).flatten().unique()
            held.setdefault(piece, []).append(terms)
            grown[piece] = grown.get(piece, 0) + len(terms)
            if grown[piece] > PIECE_TERMS:
                held[piece], grown[piece] = [pa.chunked_array(held[piece]).unique()], 0
    for piece, terms in held.items():
        distinct = pa.chunked_array(terms).unique()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), piece, np.int32)), distinct], [ASKED, "term"])


def _attached(kept: list[str], payload: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a piece's documents and its answers: the documents with their known terms."""

    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        lists = pc.split_pattern(documents.column(TERMS).combine_chunks(), BETWEEN)
        terms, times = lists.flatten(), documents.column(TIMES).combine_chunks().flatten()
        at = pc.index_in(terms, value_set=answers.column("term").combine_chunks())
        known = at.is_valid()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        before = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False))])
        rows = at.filter(known)
        columns = [terms.filter(known), times.filter(known)]
        columns += [answers.column(c).combine_chunks().take(rows) for c in payload]
        found = pa.StructArray.from_arrays(columns, ["term", "tf", *payload])
        lists = pa.ListArray.from_arrays(pa.array(before[ends.astype(np.int64)], pa.int32()), found)
        return pa.Table.from_arrays([*[documents.column(c) for c in kept], lists], [*kept, KNOWN])

    return run


def table_bytes(table: DataFrame) -> int:
    """Bytes of a per-term table in memory: its terms, and 8 for each number, at the least."""
    numbers = F.lit(0)
    for column, kind in table.dtypes:
        numbers = numbers + (F.size(column) * 8 if kind.startswith("array") else F.lit(16))
    return table.agg(F.sum(F.octet_length("term") + numbers)).first()[0] or 0


def fit_tfidf(df: DataFrame, config: TfidfConfig = TfidfConfig(), columns: Columns = DEFAULT_COLUMNS) -> TfidfModel:
    """Learn the vocabulary from training documents only."""
    statistics = materialise(term_statistics(df, config, columns), "term-statistics")
    release(df.sparkSession)
    n_docs = statistics.filter(F.col("term").isNull()).select("df").first()
    n_docs = n_docs["df"] if n_docs else 0
    return model_of(statistics.filter(F.col("term").isNotNull()), n_docs, config, columns)


def model_of(statistics: DataFrame, n_docs: int, config: TfidfConfig, columns: Columns) -> TfidfModel:
    """The vocabulary that the bounds leave of stored ``statistics(term, df, tf)``."""
    kept = statistics.filter(
        (F.col("df") >= _absolute(config.min_df, n_docs)) & (F.col("df") <= _absolute(config.max_df, n_docs))
    )
    if config.max_features is not None:
        ranked = with_sorted_position(kept, "_rank", F.desc("tf"), F.asc("term"))
        kept = ranked.filter(F.col("_rank") < config.max_features).drop("_rank")
    vocabulary = kept.withColumn("idf", config.idf(n_docs))
    return TfidfModel(config, columns, vocabulary, n_docs, kept.count())


def term_statistics(df: DataFrame, config: TfidfConfig, columns: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """``term, df, tf`` over the corpus. The row with a NULL term counts the documents,
    so that one pass gives both."""
    statistics = all_term_statistics(df, config, columns)
    if isinstance(config.min_df, int):
        statistics = statistics.filter(F.col("term").isNull() | (F.col("df") >= config.min_df))
    return statistics


def all_term_statistics(df: DataFrame, config: TfidfConfig, columns: Columns) -> DataFrame:
    """The same without bounds. Words are counted in Arrow batches, ``BATCH_WORDS`` of them at a time, so what Spark groups is
    a row per term and batch, not one per term and document."""
    if COUNTS in df.columns:
        document = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf")))
        rows = df.select(F.inline(F.concat(document, COUNTS)))
        return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))
    # A text travels cheaper than a list of words; a text without words is NULL.
    words = df.select(F.nullif(F.array_join(tokens(F.col(columns.cleaned)), " "), F.lit("")).alias("words"))
    partial = words.mapInArrow(_batch_statistics(*config.ngram_range), "term string, df long, tf long")
    return partial.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _batch_statistics(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(term, df, tf)`` of batches of documents, with the number of documents under a NULL term."""

    def counted(lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_arrays(lists)
        n_docs = len(rows)
        yield _statistics_batch(pa.array([None], pa.string()), [n_docs], [0])
        coded = rows.flatten().dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        document = np.repeat(np.arange(n_docs), sizes)
        # Runs of n words get a number each; those of n + 1 are pairs of such a number and the next word.
        grams, terms = codes, words
        for n in range(1, high + 1):
            if n > 1:
                whole = np.flatnonzero(document[: max(0, len(document) - n + 1)] == document[n - 1 :])
                pairs = grams_at[whole] * len(words) + codes[whole + n - 1]
                distinct, grams = np.unique(pairs, return_inverse=True)
                left, right = distinct // max(1, len(words)), distinct % max(1, len(words))
                terms = pc.binary_join_element_wise(terms.take(pa.array(left)), words.take(pa.array(right)), " ")
            else:
                whole = np.arange(len(codes))
            if low <= n:
                held = np.sort(grams * n_docs + document[whole])
                held = held[np.flatnonzero(np.diff(held, prepend=-1))] // n_docs  # a document has a term once
                df = np.bincount(held, minlength=len(terms))
                yield _statistics_batch(terms, df, np.bincount(grams, minlength=len(terms)))
            grams_at = np.zeros(len(codes), np.int64)
            grams_at[whole] = grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, size = [], 0
        for batch in batches:
            rows = pc.split_pattern(batch.column("words"), " ")
            lists.append(rows)
            size += len(rows.flatten())
            if size >= BATCH_WORDS:
                yield from counted(lists)
                lists, size = [], 0
        if lists:
            yield from counted(lists)

    return run


def _statistics_batch(terms: pa.Array, df: Sequence[int], tf: Sequence[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([terms.cast(pa.string()), pa.array(df, pa.int64()), pa.array(tf, pa.int64())], ["term", "df", "tf"])


def with_sorted_position(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds the global 0-based rank in ``order`` without sorting in one task.

    Range partitions are sorted on their own and stored, so that their borders
    stay fixed; a partition's offset is the sum of the sizes before it, and there
    are only as many sizes as partitions.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33)),
        "sorted",
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_size")
    offsets = sizes.select("_part", before.alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within)
        .drop("_part", "_at", "_before")
    )


def sparsity(features: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Share of zero cells of the document-term matrix in percent; 0 for an empty matrix."""
    cells = n_docs * n_terms
    nonzero = F.count(F.lit(1))
    pct = 100.0 * (1.0 - nonzero / F.lit(float(cells))) if cells else F.lit(0.0)
    return features.agg(
        F.lit(n_docs).cast("long").alias("n_docs"),
        F.lit(n_terms).cast("long").alias("n_terms"),
        nonzero.alias("n_nonzero"),
        pct.alias("sparsity_pct"),
    )


def fit_transform_split(
    train: DataFrame,
    test: DataFrame,
    config: TfidfConfig = TfidfConfig(),
    columns: Columns = DEFAULT_COLUMNS,
    keep: list[str] = (),
) -> tuple[TfidfModel, DataFrame, DataFrame]:
    """Fit on ``train`` only, transform both sides."""
    model = fit_tfidf(train, config, columns)
    return model, model.transform(train, keep), model.transform(test, keep)
