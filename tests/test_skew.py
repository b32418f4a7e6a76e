"""Hot keys: a third of all rows on one day and region must not reach the shuffle as rows."""

import pytest
from pyspark.sql import functions as F

from feedlake.operators.combine import combine_daily
from feedlake.operators.daily import linelist_cells, linelist_daily, panel_daily
from feedlake.operators.quality import dedupe_rows
from feedlake.operators.reports import region_totals, summary_stats

ROWS, TASKS, DAYS, REGIONS = 600_000, 8, 30, 20


@pytest.fixture(scope="module")
def hot(spark):
    """Days and regions spread evenly, but for a third of the rows on one of each."""
    is_hot = F.col("id") % 3 == 0
    spread = F.xxhash64("id")
    day = F.when(is_hot, F.lit(0)).otherwise(F.pmod(spread, F.lit(DAYS))).cast("int")
    region = F.when(is_hot, F.lit(0)).otherwise(F.pmod(F.shiftright(spread, 9), F.lit(REGIONS)))
    return spark.range(0, ROWS, 1, TASKS).select(
        F.date_add(F.lit("2020-03-18").cast("date"), day).alias("date"),
        region.cast("string").alias("region"),
        (F.col("id") % 50).cast("int").alias("n"),
    )


@pytest.fixture(scope="module")
def panel(hot):
    measures = ("hospitalizations", "icu_patients", "deaths", "returned_home")
    return hot.select(
        "date",
        F.col("region").alias("department_code"),
        F.lit("ALL").alias("sex"),
        F.lit("P").alias("country"),
        *[F.col("n").alias(m) for m in measures],
    )


@pytest.fixture(scope="module")
def cases(hot):
    return hot.select(
        F.col("date").alias("report_date"),
        F.col("region").alias("department_name"),
        F.col("n").alias("age"),
        F.when(F.col("n") % 2 == 0, "DECEASED").otherwise("ACTIVE").alias("status"),
        F.lit("L").alias("country"),
    )


def shuffled_records(df):
    """Records written by each shuffle of an executed plan."""
    df.collect()
    found = []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            visit(node.executedPlan())
        elif "QueryStage" in name:
            visit(node.plan())
        else:
            written = node.metrics().get("shuffleRecordsWritten")
            if written.isDefined():
                found.append(written.get().value())
            children = node.children().iterator()
            while children.hasNext():
                visit(children.next())

    visit(df._jdf.queryExecution().executedPlan())
    assert found
    return found


def test_daily_tables_shuffle_cells_and_not_rows(panel, cases):
    for daily in (panel_daily(panel), linelist_daily(cases)):
        assert max(shuffled_records(daily)) <= TASKS * DAYS * REGIONS
    assert max(shuffled_records(linelist_cells(cases))) <= TASKS * DAYS * REGIONS * 2


def test_reports_shuffle_cells_and_not_rows(panel, cases):
    summary = summary_stats(combine_daily(panel_daily(panel), linelist_daily(cases)))
    assert max(shuffled_records(summary)) <= TASKS * DAYS * REGIONS
    assert max(shuffled_records(region_totals(cases))) <= TASKS * REGIONS


def test_copies_collapse_before_the_shuffle(hot):
    distinct = DAYS * REGIONS * 50
    assert max(shuffled_records(dedupe_rows(hot))) <= TASKS * distinct


def test_hot_day_is_counted_in_full(panel, cases):
    hot_rows = panel.where("date = '2020-03-18'").count()
    assert hot_rows > ROWS / 3
    total = linelist_daily(cases).where("date = '2020-03-18'").first().total_cases
    assert total == hot_rows
