"""The queries the driver runs, each over whole tables.

``documents`` is the corpus with the language as label; ``conversations`` is the
corpus of short texts with the speaker role as label, which is hard enough to
make errors worth analysing. Fitted models are stage results that several queries
share, as they would share stored tables.
"""

from __future__ import annotations

from dataclasses import replace
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.columns import Columns
from textloom.functions import profile
from textloom.functions.text import clean_text, ngrams, tokens, unescape_html
from textloom.operators import audit, metrics, prepare, split, stats, tfidf
from textloom.operators.classifier import TextClassifier, class_weights, with_label_index
from textloom.operators.linear import TrainingSet, fit_logistic, fit_svm
from textloom.operators.naive_bayes import fit_naive_bayes
from textloom.operators.term_partitioned import LOGISTIC_LOSS, TermPartitionedSet, fit_term_partitioned, loss_gradient
from textloom.operators.term_statistics import TermStatistics
from textloom.plans import evaluation, preparation, scoring, training
from textloom.sources import artifacts, corpus, export, quoted_csv
from textloom.storage import materialise, new_path
from textloom.streaming.newest import read_newest, start_newest
from textloom.streaming.recent import recent_predictions as latest
from textloom.streaming.score_stream import parse_payload, start_scoring

LANGUAGES = ["en", "fr", "de", "es"]
ROLES = ["user", "assistant", "system"]


# Inputs -----------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """``spread`` is for queries that work through the texts."""
    names = {"ID": "doc_id", "Text": "text", "Label": "lang", "Original_Label": "source"}
    return corpus.read_parquet(spark, f"{sf_dir}/documents.parquet", names, "ID" if spread else None)


def _turn_id(conversations: DataFrame) -> DataFrame:
    return conversations.withColumn("ID", F.col("conv_id") * 1_000_000 + F.col("turn"))


def conversations(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    names = {"Text": "text", "Label": "role", "conv_id": "conv_id", "turn": "turn"}
    table = _turn_id(corpus.read_parquet(spark, f"{sf_dir}/conversations.parquet", names))
    return corpus.spread(table, "ID") if spread else table


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare(documents(spark, sf_dir, spread=True))


def prepared_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare(conversations(spark, sf_dir, spread=True))


@lru_cache(maxsize=16)
def _document_split(spark: SparkSession, sf_dir: str) -> split.StratifiedSplit:
    return split.fit_stratified_split(documents(spark, sf_dir))


@lru_cache(maxsize=16)
def _turn_split(spark: SparkSession, sf_dir: str) -> split.StratifiedSplit:
    return split.fit_stratified_split(conversations(spark, sf_dir))


def _side(fitted: split.StratifiedSplit, rows: DataFrame, side: str) -> DataFrame:
    return prepare.prepare(fitted.assign(rows).filter(F.col("split") == side))


def document_side(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return _side(_document_split(spark, sf_dir), documents(spark, sf_dir, spread=True), side)


def turn_side(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return _side(_turn_split(spark, sf_dir), conversations(spark, sf_dir, spread=True), side)


# Fitted stages ----------------------------------------------------------


@lru_cache(maxsize=16)
def document_tfidf(spark: SparkSession, sf_dir: str) -> tfidf.TfidfModel:
    return tfidf.fit_tfidf(document_side(spark, sf_dir, "train"))


@lru_cache(maxsize=16)
def document_bayes(spark: SparkSession, sf_dir: str) -> TextClassifier:
    return fit_naive_bayes(document_side(spark, sf_dir, "train"), tfidf=document_tfidf(spark, sf_dir))


@lru_cache(maxsize=16)
def turn_bayes(spark: SparkSession, sf_dir: str) -> TextClassifier:
    return fit_naive_bayes(turn_side(spark, sf_dir, "train"))


@lru_cache(maxsize=16)
def turn_training_set(spark: SparkSession, sf_dir: str) -> TrainingSet:
    return TrainingSet(turn_side(spark, sf_dir, "train"))


@lru_cache(maxsize=16)
def turn_logistic(spark: SparkSession, sf_dir: str, balanced: bool) -> TextClassifier:
    return fit_logistic(turn_training_set(spark, sf_dir), balanced)


@lru_cache(maxsize=16)
def turn_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = training.candidates(turn_side(spark, sf_dir, "train"))
    return training.compare(fits, turn_side(spark, sf_dir, "test"))[1]


def turn_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_bayes(spark, sf_dir).predict(turn_side(spark, sf_dir, "test"), keep=["Label"])


def turn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_counts(turn_predictions(spark, sf_dir))


# Text -------------------------------------------------------------------


def q_clean_text(spark, sf_dir):
    return prepared(spark, sf_dir).select("ID", "Cleaned_Text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"page_id": "page_id", "html": "html"}
    return corpus.read_parquet(spark, f"{sf_dir}/pages.parquet", names, spread_by="page_id")


def q_clean_pages(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", clean_text(F.col("html")).alias("cleaned_html"))


def q_html_unescape(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", unescape_html(F.col("html")).alias("decoded"))


def q_clean_keep_case(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return items.select("item_id", clean_text(F.col("text"), lowercase=False).alias("cleaned"))


def q_clean_change_rate(spark, sf_dir):
    return prepare.change_rate(prepared(spark, sf_dir))


def q_empty_after_cleaning(spark, sf_dir):
    return prepare.empty_after_cleaning(prepared(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_empty"))


def q_tokenize_counts(spark, sf_dir):
    words = prepared(spark, sf_dir).select("ID", tokens(F.col("Cleaned_Text")).alias("words"))
    return words.select(
        "ID",
        F.size("words").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.md5(F.array_join("words", " ")).alias("tokens_md5"),
    )


def q_ngram_counts(spark, sf_dir):
    grams = prepared_turns(spark, sf_dir).select(F.explode(ngrams(tokens(F.col("Cleaned_Text")), 1, 3)).alias("term"))
    return grams.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def q_text_profile(spark, sf_dir):
    rows = prepare.with_profile(documents(spark, sf_dir, spread=True), F.col("Text"))
    return rows.select("ID", "words", "chars", "devanagari_pct", "latin_pct", "digits")


def q_script_flags(spark, sf_dir):
    return prepare.script_flags(prepared(spark, sf_dir))


def q_validate_rows(spark, sf_dir):
    checked = prepare.validated(prepared(spark, sf_dir))
    return checked.groupBy(F.coalesce("error", F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def q_word_count(spark, sf_dir):
    return documents(spark, sf_dir, spread=True).select("ID", profile.word_count(F.col("Text")).alias("n_words"))


# Audits and statistics --------------------------------------------------


def q_null_audit(spark, sf_dir):
    return audit.null_counts(documents(spark, sf_dir))


def q_row_count_check(spark, sf_dir):
    return audit.row_count_check(documents(spark, sf_dir), 1000)


def q_label_domain(spark, sf_dir):
    return audit.label_domain(documents(spark, sf_dir), ["en", "fr", "de", "mr"])


def q_duplicate_ids(spark, sf_dir):
    by_conversation = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").alias("ID"))
    return audit.duplicate_summary(by_conversation, "ID", as_text=False)


def q_duplicate_texts(spark, sf_dir):
    return audit.duplicate_members(documents(spark, sf_dir), "Text").select("ID", "copies")


def q_duplicate_cleaned(spark, sf_dir):
    return audit.duplicate_summary(prepared(spark, sf_dir), "Cleaned_Text")


def q_label_conflicts(spark, sf_dir):
    by_source = prepared(spark, sf_dir)
    return audit.label_conflicts(by_source, Columns(label="Original_Label"))


def q_integrity_report(spark, sf_dir):
    return audit.integrity_report(prepared(spark, sf_dir), LANGUAGES)


def q_class_distribution(spark, sf_dir):
    counts = audit.class_distribution(documents(spark, sf_dir))
    return counts.withColumn("share", F.round("share", 6))


def q_corpus_stats(spark, sf_dir):
    return stats.corpus_statistics(_document_split(spark, sf_dir).assign(documents(spark, sf_dir)))


def q_category_profile(spark, sf_dir):
    return stats.category_profile(documents(spark, sf_dir, spread=True))


def q_category_samples(spark, sf_dir):
    return stats.category_samples(documents(spark, sf_dir)).select("Label", "sample_rank", "ID")


def q_category_filter(spark, sf_dir):
    return stats.in_category(documents(spark, sf_dir), " FR ").select("ID", "Label")


def q_category_check(spark, sf_dir):
    known = stats.category_check(documents(spark, sf_dir), "FR")
    return known.unionByName(stats.category_check(documents(spark, sf_dir), "Sports"))


def q_random_sample(spark, sf_dir):
    return stats.random_rows(documents(spark, sf_dir), n=10, category="en").select("ID", "Label")


# Splits -----------------------------------------------------------------


def _awkward_ids(rows: DataFrame) -> DataFrame:
    """The conversation as id, which repeats, none for every third turn, and a text that is one of many copies for the first turns."""
    text = F.when(F.col("turn") == 0, F.lit("one text of many copies")).otherwise(F.col("Text"))
    return rows.withColumn("ID", F.when(F.col("turn") % 3 != 0, F.col("conv_id"))).withColumn("Text", text)


def q_split_any_ids(spark, sf_dir):
    rows = split.stratified_split(_awkward_ids(conversations(spark, sf_dir)))
    keys = ["ID", "Label", F.md5("Text").alias("text_digest"), "split"]
    return rows.select(*keys).groupBy("ID", "Label", "text_digest", "split").agg(F.count(F.lit(1)).alias("n"))


def q_split_quota(spark, sf_dir):
    return split.split_quota(documents(spark, sf_dir))


def q_stratified_split(spark, sf_dir):
    rows = documents(spark, sf_dir).select("ID", "Label")
    return split.stratified_split(rows).select("ID", "Label", "split")


def q_split_distribution(spark, sf_dir):
    return audit.split_distribution(_document_split(spark, sf_dir).assign(documents(spark, sf_dir)))


def q_split_overlap(spark, sf_dir):
    return audit.split_overlap(_document_split(spark, sf_dir).assign(prepared(spark, sf_dir)))


def q_group_split(spark, sf_dir):
    return split.group_split(prepared(spark, sf_dir)).select("ID", "split")


def q_group_split_overlap(spark, sf_dir):
    return audit.split_overlap(split.group_split(prepared(spark, sf_dir)))


def q_split_tables(spark, sf_dir):
    rows = _document_split(spark, sf_dir).assign(prepared(spark, sf_dir))
    path = new_path(spark, "splits")
    corpus.write_splits(rows, path)
    return corpus.verify_splits(rows, path)


def q_split_scan(spark, sf_dir):
    path = new_path(spark, "splits")
    corpus.write_splits(_document_split(spark, sf_dir).assign(prepared(spark, sf_dir)), path)
    sides = [corpus.read_split(spark, path, side).withColumn("split", F.lit(side)) for side in corpus.SPLITS]
    return sides[0].unionByName(sides[1])


def q_prepare_corpus(spark, sf_dir):
    """Audit, split, store and re-read in one go."""
    path = new_path(spark, "corpus")
    return preparation.prepare_corpus(documents(spark, sf_dir, spread=True), path, LANGUAGES)["distribution"]


def q_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "corpus-csv")
    corpus.write_csv(documents(spark, sf_dir), path)
    return corpus.read_csv(spark, path)


def q_csv_reordered(spark, sf_dir):
    """Columns in another order and one more; they are found by name."""
    path = new_path(spark, "corpus-csv")
    rows = documents(spark, sf_dir).withColumn("More", F.lit("x"))
    corpus.write_csv(rows.select("Text", "More", "Original_Label", "ID", "Label"), path)
    return corpus.read_csv(spark, path)


def q_csv_quoted(spark, sf_dir):
    """Texts with line breaks, read in byte ranges."""
    path = new_path(spark, "corpus-csv")
    corpus.write_csv(documents(spark, sf_dir), path)
    return quoted_csv.read_quoted_csv(spark, path)


def q_duplicate_id_members(spark, sf_dir):
    """All turns of conversations with more than one turn."""
    turns = conversations(spark, sf_dir).select("conv_id", "turn")
    return audit.duplicate_members(turns, "conv_id", as_text=False)


def q_duplicate_cleaned_members(spark, sf_dir):
    return audit.duplicate_members(prepared(spark, sf_dir), "Cleaned_Text").select("ID", "copies")


# Features ---------------------------------------------------------------


def q_vocab_df(spark, sf_dir):
    vocabulary = document_tfidf(spark, sf_dir).indexed_vocabulary()
    return vocabulary.select("term", F.col("idx").cast("long").alias("idx"), "df", "tf", F.round("idf", 6).alias("idf"))


def _halves(spark, sf_dir) -> list[TermStatistics]:
    rows = document_side(spark, sf_dir, "train")
    return [TermStatistics.of(rows.filter(F.pmod(F.hash("ID"), F.lit(2)) == half)) for half in (0, 1)]


def _vocabulary_rows(model: tfidf.TfidfModel) -> DataFrame:
    return model.indexed_vocabulary().select("term", F.col("idx").cast("long").alias("idx"), "df", "tf", F.round("idf", 6).alias("idf"))


def q_vocab_merged(spark, sf_dir):
    """The vocabulary from the merged statistics of two halves of the training side."""
    first, second = _halves(spark, sf_dir)
    return _vocabulary_rows(first.merge(second).fit())


def q_vocab_subtracted(spark, sf_dir):
    """The same vocabulary from the statistics of all documents less those of the test side."""
    whole = TermStatistics.of(prepared(spark, sf_dir))
    return _vocabulary_rows(whole.subtract(TermStatistics.of(document_side(spark, sf_dir, "test"))).fit())


def q_term_statistics(spark, sf_dir):
    """All terms of the corpus, no bound applied, after a round trip through storage."""
    path = new_path(spark, "statistics")
    TermStatistics.of(prepared_turns(spark, sf_dir)).save(path)
    loaded = TermStatistics.load(spark, path)
    return loaded.table.withColumn("n_docs", F.lit(loaded.n_docs).cast("long"))


def q_vocab_max_features(spark, sf_dir):
    config = tfidf.TfidfConfig(min_df=0.01, max_df=0.5, max_features=500)
    model = tfidf.fit_tfidf(document_side(spark, sf_dir, "train"), config)
    return model.vocabulary.select("term", "df", "tf", F.round("idf", 6).alias("idf"))


def _features(model, rows):
    return model.transform(rows).select("ID", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def q_tfidf_train(spark, sf_dir):
    return _features(document_tfidf(spark, sf_dir), document_side(spark, sf_dir, "train"))


def q_tfidf_test(spark, sf_dir):
    return _features(document_tfidf(spark, sf_dir), document_side(spark, sf_dir, "test"))


def q_tfidf_plain(spark, sf_dir):
    """Unigrams with plain term counts and without idf."""
    config = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, sublinear_tf=False, use_idf=False)
    train = turn_side(spark, sf_dir, "train")
    return _features(tfidf.fit_tfidf(train, config), train)


def q_tfidf_vectors(spark, sf_dir):
    """The stored Spark ML vectors, measured."""
    data = turn_training_set(spark, sf_dir)
    parts = F.from_json(F.to_json(F.struct("features")), "features struct<size:long,indices:array<long>,values:array<double>>")
    stored = data.vectors if data.on_driver else data.stored_vectors()
    vectors = stored.select("ID", parts["features"].alias("v"))
    squares = F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x * x)
    return vectors.select(
        "ID",
        F.col("v.size").alias("width"),
        F.size("v.indices").cast("long").alias("n_nonzero"),
        F.round(squares, 6).alias("squared_length"),
        F.aggregate("v.indices", F.lit(0).cast("long"), lambda a, x: a + x).alias("index_sum"),
    )


def q_sparsity(spark, sf_dir):
    model = document_tfidf(spark, sf_dir)
    features = model.transform(document_side(spark, sf_dir, "train"))
    return tfidf.sparsity(features, model.n_docs, model.n_terms).withColumn("sparsity_pct", F.round("sparsity_pct", 6))


# Naive Bayes ------------------------------------------------------------


def q_label_encoding(spark, sf_dir):
    encoded = with_label_index(documents(spark, sf_dir), LANGUAGES)
    return encoded.select("ID", "Label", F.col("label_index").cast("long").alias("label_index"))


def q_class_weights(spark, sf_dir):
    return class_weights(document_side(spark, sf_dir, "train")).withColumn("weight", F.round("weight", 6))


def q_nb_theta(spark, sf_dir):
    weights = artifacts.coefficients(turn_bayes(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 6))


def q_nb_predict(spark, sf_dir):
    return turn_predictions(spark, sf_dir).select(
        "ID",
        "Label",
        "predicted_label",
        F.round("predicted_probability", 6).alias("predicted_probability"),
        "features_present_count",
    )


def q_nb_topk(spark, sf_dir):
    ranked = turn_predictions(spark, sf_dir).select("ID", F.posexplode("ranking").alias("pos", "entry"))
    return ranked.select(
        "ID",
        (F.col("pos") + 1).cast("long").alias("rank"),
        F.col("entry.label").alias("label"),
        F.round("entry.probability", 4).alias("probability"),
        profile.percentage(F.col("entry.probability")).alias("percentage"),
    )


def q_nb_documents_report(spark, sf_dir):
    classifier = document_bayes(spark, sf_dir)
    predictions = classifier.predict(document_side(spark, sf_dir, "test"), keep=["Label"])
    return _rounded(metrics.class_report(metrics.confusion_counts(predictions), LANGUAGES), "precision", "recall", "f1").drop(
        "position"
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def q_nb_accuracy(spark, sf_dir):
    overall = metrics.overall_metrics(turn_counts(spark, sf_dir), ROLES)
    return overall.select(F.round("Accuracy", 6).alias("Accuracy"))


def q_nb_macro_weighted(spark, sf_dir):
    overall = metrics.overall_metrics(turn_counts(spark, sf_dir), ROLES)
    return _rounded(overall, *overall.columns)


def q_class_report(spark, sf_dir):
    report = metrics.class_report(turn_counts(spark, sf_dir), [*ROLES, "tool"])
    return _rounded(report, "precision", "recall", "f1").drop("position")


def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(turn_counts(spark, sf_dir), ROLES).select("actual", "predicted", "n")


def q_confusion_wide(spark, sf_dir):
    return metrics.wide_confusion_matrix(turn_counts(spark, sf_dir), ROLES)


def q_confusion_normalized(spark, sf_dir):
    cells = metrics.normalised_confusion(turn_counts(spark, sf_dir), [*ROLES, "tool"])
    return _rounded(cells, "share").select("actual", "predicted", "n", "share")


def q_metric_gate(spark, sf_dir):
    overall = metrics.overall_metrics(turn_counts(spark, sf_dir), ROLES)
    return _rounded(metrics.metric_gate(overall, {"Accuracy": 0.5, "Macro_F1": 0.5}, 0.25), "value")


def q_error_analysis(spark, sf_dir):
    return metrics.error_analysis(turn_predictions(spark, sf_dir), conversations(spark, sf_dir))


def q_error_pairs(spark, sf_dir):
    return metrics.error_pairs(turn_counts(spark, sf_dir), top=10)


def q_confidence_strata(spark, sf_dir):
    return metrics.confidence_strata(turn_predictions(spark, sf_dir))


def q_nb_top_features(spark, sf_dir):
    return turn_bayes(spark, sf_dir).top_terms(20).withColumn("Rank", F.col("Rank").cast("long"))


def q_nb_explain(spark, sf_dir):
    explained = turn_bayes(spark, sf_dir).explain(turn_side(spark, sf_dir, "test"))
    return explained.select(
        "ID", "predicted_label", "features_present_count", F.posexplode("top_contributing_features").alias("pos", "t")
    ).select(
        "ID",
        "predicted_label",
        "features_present_count",
        (F.col("pos") + 1).cast("long").alias("rank"),
        F.col("t.term").alias("term"),
        F.col("t.contribution").alias("contribution"),
        F.col("t.tfidf").alias("tfidf"),
        F.col("t.coefficient").alias("coefficient"),
        F.col("t.is_positive").alias("is_positive"),
    )


def q_nb_explain_all_terms(spark, sf_dir):
    explained = turn_bayes(spark, sf_dir).explain(turn_side(spark, sf_dir, "test"))
    return explained.select("ID", F.inline("all_present_features")).select("ID", "term", "contribution", "tfidf")


# Scoring ----------------------------------------------------------------


def _scored(records: DataFrame) -> DataFrame:
    return records.select("ID", "predicted_label", "predicted_probability", "confidence_percentage", "error")


def _with_blanks(rows: DataFrame) -> DataFrame:
    """The system turns lose their text, so that the error rows have something to report."""
    emptied = F.when(F.col("Label") == "system", F.when(F.col("ID") % 2 == 0, F.lit(" \t ")).otherwise(F.lit("\u200b")))
    return rows.withColumn("Text", F.coalesce(emptied, F.col("Text")))


def q_batch_errors(spark, sf_dir):
    rows = _with_blanks(conversations(spark, sf_dir, spread=True))
    return _scored(scoring.score_batch(turn_bayes(spark, sf_dir), rows))


def q_predict_and_explain(spark, sf_dir):
    record = scoring.score_and_explain(turn_bayes(spark, sf_dir), conversations(spark, sf_dir, spread=True))
    return record.select(
        "ID",
        "predicted_label",
        "predicted_probability",
        "features_present_count",
        F.get("top_predictions", F.lit(1))["label"].alias("second_label"),
        F.get("top_contributing_features", F.lit(0))["term"].alias("top_term"),
        F.size("all_class_probabilities").cast("long").alias("n_classes"),
    )


def _repeated_ids(rows: DataFrame) -> DataFrame:
    """The conversation as id, which repeats, and none for every fifth turn."""
    return rows.withColumn("ID", F.when(F.col("turn") % 5 != 4, F.col("conv_id")))


def q_score_repeated_ids(spark, sf_dir):
    rows = _repeated_ids(conversations(spark, sf_dir, spread=True))
    scored = scoring.score_batch(turn_bayes(spark, sf_dir), rows)
    return scored.select("ID", "conv_id", "turn", "predicted_label", "predicted_probability", "error")


def q_explain_repeated_ids(spark, sf_dir):
    rows = _repeated_ids(conversations(spark, sf_dir, spread=True))
    record = scoring.score_and_explain(turn_bayes(spark, sf_dir), rows)
    return record.select("ID", "conv_id", "turn", "predicted_label", "features_present_count")


def q_all_class_probabilities(spark, sf_dir):
    """Every class of every turn with its probability."""
    scored = scoring.score_batch(turn_bayes(spark, sf_dir), conversations(spark, sf_dir, spread=True))
    return scored.select("ID", F.explode("all_class_probabilities").alias("label", "probability"))


def q_score_unseen(spark, sf_dir):
    """The language model applied to the benchmark table."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("ID"), F.col("text").alias("Text"))
    return _scored(scoring.score_batch(document_bayes(spark, sf_dir), items)).drop("error")


def q_prediction_export(spark, sf_dir):
    scored = scoring.score_batch(turn_bayes(spark, sf_dir), conversations(spark, sf_dir, spread=True))
    report = export.prediction_report(scored, at=F.timestamp_seconds(F.col("ID")))
    path = new_path(spark, "report-csv")
    export.write_prediction_report(report, path)
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return read.toDF(*export.REPORT_COLUMNS)


def q_model_roundtrip(spark, sf_dir):
    path = new_path(spark, "model")
    artifacts.save_classifier(turn_bayes(spark, sf_dir), path)
    loaded = artifacts.load_classifier(spark, path)
    predictions = loaded.predict(turn_side(spark, sf_dir, "test"), keep=["Label"])
    return predictions.select("ID", "Label", "predicted_label", F.round("predicted_probability", 6).alias("predicted_probability"))


def q_model_metadata(spark, sf_dir):
    path = new_path(spark, "model")
    artifacts.save_classifier(turn_bayes(spark, sf_dir), path)
    row = artifacts.read_metadata(spark, path)
    return row.select(
        "model",
        F.array_join("classes", ",").alias("classes"),
        "training_documents",
        "vocabulary_size",
    )


def q_model_versions(spark, sf_dir):
    """Two models saved under one path, then the first made current again."""
    path = new_path(spark, "model")
    few = fit_naive_bayes(turn_side(spark, sf_dir, "train"), tfidf.TfidfConfig(max_features=500), alpha=0.5)
    first = artifacts.save_classifier(turn_bayes(spark, sf_dir), path)
    artifacts.save_classifier(few, path)
    artifacts.publish(spark, path, first)
    told = [
        artifacts.read_metadata(spark, path, version).select(
            F.lit(i).cast("long").alias("publication"),
            "token_pattern",
            F.col("hyperparameters")["alpha"].alias("alpha"),
            "max_features",
            "training_documents",
            F.lit(artifacts.load_classifier(spark, path, version).terms.count()).cast("long").alias("stored_terms"),
            F.lit(version == artifacts.current_version(spark, path)).alias("is_current"),
        )
        for i, version in enumerate(artifacts.publications(spark, path), 1)
    ]
    return reduce(DataFrame.unionByName, told)


def q_stream_score(spark, sf_dir):
    """The conversation table replayed as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/conversations.parquet").schema
    # A pattern, as the table is a file or a folder of them, and a stream takes a plain path for a folder.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/conversations.parque[t]")
    payload = _turn_id(stream).withColumn("value", F.to_json(F.struct(F.col("text").alias("headline"))))
    texts = parse_payload(payload.select("ID", "value")).drop("value")
    output, state = new_path(spark, "stream-output"), new_path(spark, "stream-state")
    start_scoring(turn_bayes(spark, sf_dir), texts, output, state, available_now=True).awaitTermination()
    return _scored(spark.read.parquet(output)).drop("error")


def q_recent_predictions(spark, sf_dir):
    log = turn_bayes(spark, sf_dir).predict(prepared_turns(spark, sf_dir), keep=["conv_id", "turn", "Label"])
    newest = latest(log, session="Label", at="conv_id", tie="turn")
    return newest.select("Label", F.col("position").cast("long").alias("position"), "ID", "predicted_label")


def q_recent_stream(spark, sf_dir):
    """The same, kept by a stream that the log reaches in four parts, each with turns from everywhere."""
    log = turn_bayes(spark, sf_dir).predict(prepared_turns(spark, sf_dir), keep=["conv_id", "turn", "Label"])
    log = log.select("ID", "conv_id", "turn", "Label", "predicted_label")
    arriving, output, state = (new_path(spark, name) for name in ("log", "newest", "newest-state"))
    log.repartition(4, "ID").write.parquet(arriving)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    start_newest(stream, output, state, "Label", ["conv_id", "turn"], fold_every=2, available_now=True).awaitTermination()
    newest = read_newest(spark, output, log.schema, "Label", ["conv_id", "turn"])
    return newest.select("Label", F.col("position").cast("long").alias("position"), "ID", "predicted_label")


# Spark ML candidates ----------------------------------------------------


def _evaluated(spark, sf_dir, classifier: TextClassifier) -> DataFrame:
    predictions = classifier.predict(turn_side(spark, sf_dir, "test"), keep=["Label"])
    overall = metrics.overall_metrics(metrics.confusion_counts(predictions), ROLES)
    return overall.withColumn("Model", F.lit(classifier.name))


def q_lr_train_eval(spark, sf_dir):
    return _evaluated(spark, sf_dir, turn_logistic(spark, sf_dir, False))


def _calibration(spark, sf_dir, balanced: bool) -> DataFrame:
    """Mean probability per class over the training rows, weighted as in the fit. Without a
    penalty on the intercepts this is each class's share of the weight."""
    predicted = turn_logistic(spark, sf_dir, balanced).predict(turn_side(spark, sf_dir, "train"), keep=["Label"])
    if balanced:
        weights = class_weights(turn_side(spark, sf_dir, "train")).select(F.col("label").alias("Label"), "weight")
        predicted = predicted.join(weights, "Label")
    else:
        predicted = predicted.withColumn("weight", F.lit(1.0))
    rows = predicted.select("weight", F.inline("ranking"))
    mean = F.sum(F.col("weight") * F.col("probability")) / F.sum("weight")
    return rows.groupBy("label").agg(F.round(mean, 3).alias("mean_probability"))


def q_lr_calibration(spark, sf_dir):
    return _calibration(spark, sf_dir, False)


def q_lr_balanced_calibration(spark, sf_dir):
    return _calibration(spark, sf_dir, True)


def q_lr_balanced_train_eval(spark, sf_dir):
    return _evaluated(spark, sf_dir, turn_logistic(spark, sf_dir, True))


def q_svm_train_eval(spark, sf_dir):
    return _evaluated(spark, sf_dir, fit_svm(turn_training_set(spark, sf_dir)))


def q_svm_balanced_train_eval(spark, sf_dir):
    return _evaluated(spark, sf_dir, fit_svm(turn_training_set(spark, sf_dir), balanced=True))


def q_model_comparison(spark, sf_dir):
    return turn_comparison(spark, sf_dir)


def q_fused_nb_metrics(spark, sf_dir):
    """Two naive Bayes models, by the smoothing they have, measured out of one pass over the test side."""
    train = turn_side(spark, sf_dir, "train")
    vocabulary = tfidf.fit_tfidf(train)
    fits = {str(a): (lambda a=a: replace(fit_naive_bayes(train, alpha=a, tfidf=vocabulary), name=str(a))) for a in (1.0, 0.1)}
    rows = training.compare(fits, turn_side(spark, sf_dir, "test"))[1]
    return _rounded(rows.drop("Training_Time", "Prediction_Time"), *[c for c in rows.columns if c.startswith(("Acc", "Macro", "Weighted"))])


def q_lr_bayes_gradient(spark, sf_dir):
    """The gradient of the logistic loss by every weight, at the weights of naive Bayes."""
    bayes = turn_bayes(spark, sf_dir)
    data = TermPartitionedSet(turn_side(spark, sf_dir, "train"), tfidf=tfidf.fit_tfidf(turn_side(spark, sf_dir, "train")))
    try:
        gradient = materialise(loss_gradient(data, bayes.terms, bayes.intercepts, LOGISTIC_LOSS, [1.0] * len(bayes.labels)), "gradient")
    finally:
        data.close()
    labels = F.array(*[F.lit(label) for label in data.labels])
    rows = gradient.select("term", F.inline(F.arrays_zip(labels.alias("label"), F.col("gradient").alias("gradient"))))
    return rows.select("term", "label", (F.round("gradient", 6) + 0.0).alias("gradient"))


def q_lr_term_partitioned(spark, sf_dir):
    """Balanced logistic regression in tables beside the one on the driver: per class its terms, and whether all weights agree."""
    train = turn_side(spark, sf_dir, "train")
    data = TermPartitionedSet(train, tfidf=turn_training_set(spark, sf_dir).tfidf)
    try:
        mine = fit_term_partitioned(data, "tables", balanced=True)
    finally:
        data.close()
    theirs = turn_logistic(spark, sf_dir, True).terms.select("term", F.col("weights").alias("other"))
    labels = F.array(*[F.lit(label) for label in mine.labels])
    pairs = mine.terms.join(theirs, "term").select(F.inline(F.arrays_zip(labels.alias("label"), "weights", "other")))
    agrees = F.max(F.abs(F.col("weights") - F.col("other"))) < 1e-3
    return pairs.groupBy("label").agg(F.count(F.lit(1)).alias("n_terms"), agrees.alias("agrees"))


def q_model_selection(spark, sf_dir):
    return training.select_model(turn_comparison(spark, sf_dir)).select("Model", "Macro_F1", "Supports_Proba")


def q_full_evaluation(spark, sf_dir):
    reports = evaluation.evaluate(turn_logistic(spark, sf_dir, True), turn_side(spark, sf_dir, "test"), ROLES)
    path = new_path(spark, "reports")
    evaluation.write_reports(reports, path)
    return reports["error_pairs"]


def q_lr_explain(spark, sf_dir):
    return scoring.explain_only(turn_logistic(spark, sf_dir, True), conversations(spark, sf_dir, spread=True))


def q_lr_explain_terms(spark, sf_dir):
    """What of an explanation does not depend on the weights: the terms and their TF-IDF."""
    explained = turn_logistic(spark, sf_dir, True).explain(turn_side(spark, sf_dir, "test"))
    return explained.select("ID", F.inline("all_present_features")).select("ID", "term", "tfidf")


def q_lr_top_features(spark, sf_dir):
    return turn_logistic(spark, sf_dir, True).top_terms(20)


def q_production_refit(spark, sf_dir):
    rows = prepare.prepare(_turn_split(spark, sf_dir).assign(conversations(spark, sf_dir, spread=True)))
    path = new_path(spark, "production")
    training.train_production(rows, path)
    fixed = artifacts.read_metadata(spark, path)
    return fixed.select("model", F.array_join("classes", ",").alias("classes"), "training_documents", "vocabulary_size")


def q_candidate_class_f1(spark, sf_dir):
    """Per-class F1 of balanced logistic regression on the held-out turns."""
    predictions = turn_logistic(spark, sf_dir, True).predict(turn_side(spark, sf_dir, "test"), keep=["Label"])
    return metrics.class_report(materialise(metrics.confusion_counts(predictions), "counts"), ROLES)


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
