"""The operators that SQL can express, against SQL on the smallest test tables."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle_check import connect, differences
from patronlens.llm.oracle import ORACLE
from patronlens.llm.queries import QUERIES

NATIVE = {"op1_secrets", "op3_chat", "op8_mix", "op10_licenses"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert differences(df, connect(sf_dir), oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert name not in NATIVE or not re.search("Python|Pandas|Arrow", plan)


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in queries() if re.match(r"op\d+_|pipeline$", n)]
    assert len(names) == 14 and set(QUERIES) | {"pipeline"} == set(names)
    assert set(ORACLE) <= set(oracle_sql())
