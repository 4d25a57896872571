"""The stages as jobs for ``spark-submit``, with the repository on ``PYTHONPATH``.

    spark-submit textloom/jobs.py prepare  --corpus corpus.csv --out data
    spark-submit textloom/jobs.py compare  --data data --out reports
    spark-submit textloom/jobs.py evaluate --data data --out reports
    spark-submit textloom/jobs.py produce  --data data --out models
    spark-submit textloom/jobs.py score    --model models --texts new.parquet --out scores [--explain]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from textloom.operators import linear
from textloom.plans import evaluation, preparation, scoring, training
from textloom.sources import artifacts, corpus


def _sides(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    table = spark.read.parquet(path)
    return table.filter("split = 'train'").drop("split"), table.filter("split = 'test'").drop("split")


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = spark.read.parquet(args.corpus) if args.format == "parquet" else corpus.read_csv(spark, args.corpus)
    reports = preparation.prepare_corpus(raw, args.out, args.labels, args.test_size, args.seed, args.by_text)
    for name in ("integrity", "distribution", "overlap", "written"):
        reports[name].show(truncate=False)


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    train, test = _sides(spark, args.data)
    _, results = training.compare(training.candidates(train), test)
    corpus.write_report(results, f"{args.out}/model_results")
    results.show(truncate=False)
    training.select_model(results).select("Model").show(truncate=False)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    train, test = _sides(spark, args.data)
    classifier = linear.fit_logistic(linear.TrainingSet(train), balanced=True)
    reports = evaluation.evaluate(classifier, test, args.labels)
    evaluation.write_reports(reports, args.out)
    for name in ("metrics", "class_report", "confusion_wide", "confidence_strata"):
        reports[name].show(truncate=False)
    reports["error_pairs"].limit(10).show(truncate=False)


def produce(spark: SparkSession, args: argparse.Namespace) -> None:
    training.train_production(spark.read.parquet(args.data), args.out)
    artifacts.read_metadata(spark, args.out).show(truncate=False, vertical=True)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    classifier = artifacts.load_classifier(spark, args.model)
    run = scoring.score_and_explain if args.explain else scoring.score_batch
    run(classifier, spark.read.parquet(args.texts)).write.mode("overwrite").parquet(args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textloom")
    stages = top.add_subparsers(required=True)

    def stage(run, *paths: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(run.__name__)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        sub.set_defaults(run=run)
        return sub

    preparing = stage(prepare, "corpus", "out")
    preparing.add_argument("--labels", nargs="+", required=True, help="expected labels; others fail the label check")
    preparing.add_argument("--format", choices=("parquet", "csv"), default="parquet", help="of the corpus, a file or a folder")
    preparing.add_argument("--test-size", type=float, default=0.2)
    preparing.add_argument("--seed", type=int, default=42)
    preparing.add_argument("--by-text", action="store_true", help="keep copies of a text on one side")
    stage(compare, "data", "out")
    stage(evaluate, "data", "out").add_argument("--labels", nargs="+", help="label order in reports")
    stage(produce, "data", "out")
    stage(score, "model", "texts", "out").add_argument("--explain", action="store_true")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("textloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
