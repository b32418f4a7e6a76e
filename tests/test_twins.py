"""Every registered query against its SQL twin, and checks of the plans they run as."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "Pandas")
# Only one-row aggregates, per-country results and row limits may pass through one task.
SINGLE = {
    "country_stats", "daily_sample", "feed_sample", "feed_schema", "header_checks", "inferred_types",
    "metrics_file",
    "null_counts", "overall_stats", "quality_report", "sorted_csv",
}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_library_query_has_a_twin():
    assert contract.QUERIES.keys() == contract.TWINS.keys()


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query_equals_its_twin(spark, connection, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, connection, contract.oracle_sql()[name]) is None
    plan = plan_of(df)
    assert not [word for word in NEVER if word in plan]
    if "SinglePartition" in plan.split("Subquery")[0]:
        assert name in SINGLE or "trend" in name


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_total_category_reaches_the_scan(spark, tmp_path):
    from feedlake.operators.daily import panel_daily

    path = str(tmp_path / "panel")
    contract.queries()["panel_format"](spark, SF_DIR).write.parquet(path)
    plan = plan_of(panel_daily(spark.read.parquet(path)))
    assert "In(sex, [0,ALL])" in plan or "In(sex, [ALL,0])" in plan
    assert "IsNotNull(date)" in plan
