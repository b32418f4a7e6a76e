from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedlake.feeds import COMBINED_SCHEMA
from feedlake.operators.combine import (
    ZERO_FORM,
    combine_daily,
    combine_daily_zero,
    with_hospital_rates,
)
from feedlake.operators.daily import (
    PANEL_BRIEF_SUMS,
    linelist_cells,
    linelist_daily,
    linelist_daily_joined,
    panel_daily,
)

D1, D2, D3 = date(2020, 3, 18), date(2020, 3, 19), date(2020, 3, 20)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(
        [
            ("01", "ALL", D1, 10, 1, 2, 3, "P"),
            ("01", "M", D1, 6, 1, 1, 2, "P"),
            ("01", "F", D1, 4, 0, 1, 1, "P"),
            ("02", "ALL", D1, 5, None, None, 1, "P"),
            ("02", "0", D2, 7, 2, 1, None, "P"),
            ("03", "ALL", D2, None, None, 4, None, "P"),
            (None, "ALL", D2, 1, None, None, None, "P"),
            ("01", "M", D3, 6, 1, 1, 2, "P"),
            ("01", "ALL", None, 99, 9, 9, 9, "P"),
        ],
        "department_code string, sex string, date date, hospitalizations int, icu_patients int, "
        "returned_home int, deaths int, country string",
    )


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(
        [
            (D1, "a", 40, "DECEASED", "L"),
            (D1, "a", 20, "RECOVERED", "L"),
            (D1, "b", None, "ACTIVE", "L"),
            (D2, None, None, "Leve", "L"),
            (D2, "b", None, "UNKNOWN", "L"),
            (D3, "b", 7, "DECEASED", "L"),
            (None, "b", 7, "DECEASED", "L"),
        ],
        "report_date date, department_name string, age int, status string, country string",
    )


def as_tuples(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_panel_daily_adds_up_the_total_category(panel):
    assert as_tuples(panel_daily(panel), "date") == [
        (D1, "P", 15, 1, 4, 2, 2),
        (D2, "P", 8, 2, None, 5, 2),
    ]


def test_panel_daily_over_all_categories(panel):
    rows = as_tuples(panel_daily(panel, categories=None), "date")
    assert rows[0] == (D1, "P", 25, 2, 7, 4, 2)
    assert [r[0] for r in rows] == [D1, D2, D3]


def test_panel_daily_brief(panel):
    brief = panel_daily(panel, ("ALL",), PANEL_BRIEF_SUMS, regions=False)
    assert as_tuples(brief, "date") == [(D1, "P", 15, 1, 4), (D2, "P", 1, None, None)]


def test_linelist_daily(cases):
    assert as_tuples(linelist_daily(cases), "date") == [
        (D1, "L", 3, 1, 1, 1, 2, 30.0),
        (D2, "L", 2, 0, 0, 0, 1, None),
        (D3, "L", 1, 1, 0, 0, 1, 7.0),
    ]


def test_approximate_regions_are_exact_on_few(panel, cases):
    for exact, approximate in (
        (panel_daily(panel), panel_daily(panel, exact_regions=False)),
        (linelist_daily(cases), linelist_daily(cases, exact_regions=False)),
    ):
        assert as_tuples(exact, "date") == as_tuples(approximate, "date")


def test_joined_form_agrees_with_the_single_aggregation(cases):
    columns = ["date", "total_cases", "regions_count", "avg_age", "total_deaths", "total_recovered"]
    joined = linelist_daily_joined(linelist_cells(cases)).select(*columns)
    assert as_tuples(joined, "date") == as_tuples(linelist_daily(cases).select(*columns), "date")


def test_combined_schema_and_missing_measures(panel, cases):
    stamp = datetime(2024, 1, 31, 12)
    combined = combine_daily(panel_daily(panel), linelist_daily(cases), processed_at=stamp)
    assert [(f.name, f.dataType) for f in combined.schema] == [
        (f.name, f.dataType) for f in COMBINED_SCHEMA
    ]
    rows = as_tuples(combined, "date", "country")
    assert rows[0] == (D1, "L", 3, None, None, 1, 1, 1, 2, 30.0, 33.33, 33.33, stamp)
    assert rows[1] == (D1, "P", None, 15, 1, 4, 2, None, 2, None, None, None, stamp)
    assert len(rows) == panel_daily(panel).count() + linelist_daily(cases).count()


def test_parts_never_exceed_cases(panel, cases):
    combined = combine_daily(panel_daily(panel), linelist_daily(cases))
    parts = F.expr("total_deaths + total_recovered + active_cases")
    assert combined.where(parts > F.col("total_cases")).isEmpty()


def test_zero_form_is_the_null_form_with_zeros(panel, cases):
    dailies = panel_daily(panel), linelist_daily(cases)
    zero = combine_daily_zero(*dailies)
    assert tuple(zero.columns) == ZERO_FORM
    totals = [c for c in ZERO_FORM if c.startswith("total_")]
    expected = (
        combine_daily(*dailies)
        .na.fill(0, totals)
        .withColumn("avg_age", F.when(F.col("country") == "P", 0.0).otherwise(F.col("avg_age")))
        .withColumn("date", F.col("date").cast("string"))
        .select(*ZERO_FORM)
    )
    assert as_tuples(zero, "date", "country") == as_tuples(expected, "date", "country")


def test_hospital_rates(spark):
    df = spark.createDataFrame(
        [(D1, 200, 50, 5), (D2, 0, 0, 1), (D3, None, 8, 1)],
        "date date, total_cases long, total_hospitalizations long, total_icu long",
    )
    rows = with_hospital_rates(df).orderBy("date").collect()
    assert [(r.hospitalization_rate, r.icu_rate) for r in rows] == [
        (25.0, 10.0),
        (None, None),
        (None, 12.5),
    ]
