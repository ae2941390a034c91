"""Every query that SQL can express, against SQL on the smallest test tables."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import connect, differences
from patronlens.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# Hundreds of boosting rounds or eighty clusterings each: compared by oracle_check.py, and the operators by tests/test_models.py
# and tests/test_recommend.py with small settings.
LONG_FITS = {"k_sweep_valid", "model_comparison_valid", "reco_ranker_valid", "recommend_top1_valid"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LONG_FITS))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    assert differences(df, con, oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|PythonUDF|MapInPandas", plan)


def test_entry_gives_one_row_per_customer(spark):
    table = entry(spark)
    assert len(table.columns) == 40
    assert table.count() == table.select("customer_id").distinct().count() == 160


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())
