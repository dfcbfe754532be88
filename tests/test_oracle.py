"""Every registered query gives the rows of its SQL, by a plan that can grow."""

import pytest

import __spark_entry__
import oracle
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# Pairs of all rows with all rows, or rows that leave for Python one batch at a time.
UNWANTED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "PythonUDTF",
)


@pytest.fixture(scope="module")
def database():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    df = QUERIES[name].build(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    count, found = oracle.differences(df, database, QUERIES[name])
    assert not found
    assert count > 0


def test_contract_of_the_entry_file(spark):
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 150
