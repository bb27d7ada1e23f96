"""Plan checks at scale: no Python UDF nodes and no window without a partition key."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
UNPARTITIONED_WINDOW = re.compile(r"Window \[[^\n]*\], \[\], ")


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_plan_is_jvm_only_and_partitioned(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert not UNPARTITIONED_WINDOW.search(plan), plan


@pytest.mark.parametrize("name", ["svd_tfidf", "svd_countvec", "svd_gram"])
def test_no_row_goes_through_an_rdd_or_a_literal_vocabulary(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ExternalRDD" not in plan and "ExistingRDD" not in plan and "map(" not in plan
