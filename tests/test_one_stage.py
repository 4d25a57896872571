"""Training inside one stage."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import one_stage, term_partitioned
from textloom.operators.term_partitioned import LOGISTIC_LOSS, SQUARED_HINGE, TermPartitionedSet, fit_term_partitioned
from textloom.storage import list_names, shared_dir


def table(model) -> dict:
    return {r.term: np.array(r.weights) for r in model.terms.collect()}


def exchanges(spark) -> list[str]:
    return [x for x in list_names(spark, f"{shared_dir(spark)}/textloom") if x.startswith("exchange")]


@pytest.mark.parametrize("loss", [LOGISTIC_LOSS, SQUARED_HINGE])
def test_a_fit_takes_few_jobs_and_finds_what_passes_find(spark, headlines, monkeypatch, loss):
    """Several tasks, and documents whose terms are all unknown. Before, every pass over the features was two jobs and more."""
    monkeypatch.setattr(one_stage, "TASK_ENTRIES", 10)
    extra = spark.range(100, 103).selectExpr("id AS ID", "if(id = 100, '', concat('unknown', id)) AS Cleaned_Text", "'Sports' AS Label")
    data = TermPartitionedSet(headlines.select("ID", "Cleaned_Text", "Label").unionByName(extra))
    context = spark.sparkContext
    try:
        assert one_stage.tasks_for(spark, data.entries) > 2
        data.cells()
        before = exchanges(spark)
        context.setJobGroup(f"fit {loss.name}", "training")
        together = fit_term_partitioned(data, "tables", loss, balanced=True)
        context.setLocalProperty("spark.jobGroup.id", None)
        assert len(context.statusTracker().getJobIdsForGroup(f"fit {loss.name}")) < 20
        assert exchanges(spark) == before
        monkeypatch.setattr(term_partitioned, "runs_together", lambda *a: False)
        by_passes = fit_term_partitioned(data, "tables", loss, balanced=True)
    finally:
        data.close()
    a, b = table(together), table(by_passes)
    assert a.keys() == b.keys() and max(np.abs(a[t] - b[t]).max() for t in a) < 2e-4
    assert together.intercepts == pytest.approx(by_passes.intercepts, abs=2e-4)


def test_where_tasks_may_not_run_together(spark, monkeypatch):
    folder = shared_dir(spark)
    assert one_stage.runs_together(spark, folder)
    assert not one_stage.runs_together(spark, "viewfs://store/in")


def test_an_empty_side_of_terms(spark):
    """No term is known: the weights are none, the intercepts tell the classes' shares."""
    rows = spark.createDataFrame([(i, f"w{i}", "a" if i < 3 else "b") for i in range(4)], "ID long, Cleaned_Text string, Label string")
    data = TermPartitionedSet(rows)
    try:
        model = fit_term_partitioned(data, "tables")
    finally:
        data.close()
    assert model.terms.agg(F.count("*")).first()[0] == 0
    assert model.intercepts[0] - model.intercepts[1] == pytest.approx(np.log(3), abs=1e-4)


def test_small_vectors_are_few_tasks(spark, headlines):
    """Spark ML runs a job over the vectors for every step; thirteen documents were as many tasks as files before."""
    from textloom.operators.linear import TrainingSet

    data = TrainingSet(headlines.repartition(7, "ID"))
    assert data.on_driver and data.packed.rdd.getNumPartitions() == 1
    assert sorted(r.ID for r in data.packed.collect()) == list(range(1, 14))
