"""Formatted feeds to one row per day and country.

Every aggregate combines on the map side first, so a day or region holding a large share of the
rows reaches the shuffle as a handful of partial rows. The single distinct count expands to
(day, country, region) before it is merged, which spreads a hot day over its regions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Result column names and the codes they count.
PANEL_SUMS = {
    "total_hospitalizations": "hospitalizations",
    "total_icu": "icu_patients",
    "total_deaths": "deaths",
    "total_recovered": "returned_home",
}
PANEL_BRIEF_SUMS = {
    "total_hospitalizations": "hospitalizations",
    "total_icu": "icu_patients",
    "total_deaths": "deaths",
}
TOTAL_CATEGORIES = ("ALL", "0")
STATUS_COUNTS = {
    "total_deaths": "DECEASED",
    "total_recovered": "RECOVERED",
    "active_cases": "ACTIVE",
}


def _regions(column: str, exact: bool) -> Column:
    """Distinct regions; the approximate count spares the second shuffle."""
    count = F.count_distinct(column) if exact else F.approx_count_distinct(column)
    return count.alias("regions_count")


def panel_daily(
    panel: DataFrame,
    categories: Sequence[str] | None = TOTAL_CATEGORIES,
    sums: Mapping[str, str] = PANEL_SUMS,
    regions: bool = True,
    exact_regions: bool = True,
) -> DataFrame:
    """Sums per day over the total category, or over all categories with ``categories=None``.

    The latter adds the total to its own parts; it exists for results that were built that way.
    """
    # The category comes first: it is cheap and spares the other rows the date test.
    rows = panel if categories is None else panel.where(F.col("sex").isin(*categories))
    measures = [F.sum(source).alias(name) for name, source in sums.items()]
    if regions:
        measures.append(_regions("department_code", exact_regions))
    return rows.where(F.col("date").isNotNull()).groupBy("date", "country").agg(*measures)


def linelist_daily(
    cases: DataFrame,
    status_counts: Mapping[str, str] = STATUS_COUNTS,
    exact_regions: bool = True,
) -> DataFrame:
    """Cases per day, counts by status, distinct regions and mean age, in one aggregation."""
    by_status = [
        F.count_if(F.col("status") == status).alias(name) for name, status in status_counts.items()
    ]
    return (
        cases.where(F.col("report_date").isNotNull())
        .groupBy(F.col("report_date").alias("date"), "country")
        .agg(
            F.count("*").alias("total_cases"),
            *by_status,
            _regions("department_name", exact_regions),
            F.avg("age").alias("avg_age"),
        )
    )


def linelist_cells(cases: DataFrame) -> DataFrame:
    """Case counts and age sums per day, region and status: the small base of the joined form."""
    return (
        cases.where(F.col("report_date").isNotNull())
        .groupBy(F.col("report_date").alias("date"), "department_name", "status")
        .agg(
            F.count("*").alias("cases"),
            F.sum("age").alias("age_sum"),
            F.count("age").alias("aged"),
        )
    )


def linelist_daily_joined(cells: DataFrame) -> DataFrame:
    """The line-list day table assembled by joining separate per-day aggregates.

    Regions and mean age join inner, the status counts join left and read 0 where a day has none.
    Hand it written cells (``plans.shared.settle``), so that the feed itself is scanned only once.
    """

    def cases_with(status: str, name: str) -> DataFrame:
        matching = cells.where(F.col("status") == status)
        return matching.groupBy("date").agg(F.sum("cases").alias(name))

    total = cells.groupBy("date").agg(F.sum("cases").alias("total_cases"))
    regions = cells.groupBy("date").agg(F.count_distinct("department_name").alias("regions_count"))
    ages = cells.groupBy("date").agg(
        F.try_divide(F.sum("age_sum"), F.sum("aged")).alias("avg_age")
    )
    return (
        total.join(regions, "date")
        .join(ages, "date")
        .join(cases_with("DECEASED", "total_deaths"), "date", "left")
        .join(cases_with("RECOVERED", "total_recovered"), "date", "left")
        .withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("total_deaths", "total_recovered")}
        )
    )
