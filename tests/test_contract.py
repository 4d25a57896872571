"""Every registered query on the smallest tables, beside its SQL where it has one."""

from __future__ import annotations

import os

import pytest
from contract_check import compare, connection

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    assert not compare(spark, con, name, contract.queries()[name], contract.oracle_sql().get(name), SF_DIR)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["label", "precision", "recall", "f1", "support"] and df.count() == 4
