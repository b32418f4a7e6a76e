"""Day tables of several feeds to one comparable table."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.feeds import COMBINED_SCHEMA
from feedlake.functions import guarded_pct

# Measures of the combined table, and the columns of its zero-filled form.
MEASURES = tuple(
    f
    for f in COMBINED_SCHEMA.fields
    if f.name not in ("mortality_rate", "recovery_rate", "processed_at")
)
ZERO_FORM = (
    "date",
    "country",
    "total_cases",
    "total_hospitalizations",
    "total_icu",
    "total_deaths",
    "total_recovered",
    "regions_count",
    "avg_age",
)


def _aligned(daily: DataFrame, absent: str) -> DataFrame:
    """The measure columns in order and type; those the feed does not report read ``absent``."""
    return daily.selectExpr(
        [
            f"cast({f.name if f.name in daily.columns else absent} as {f.dataType.simpleString()})"
            f" as {f.name}"
            for f in MEASURES
        ]
    )


def _stacked(dailies: tuple[DataFrame, ...], absent: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [_aligned(d, absent) for d in dailies])


def combine_daily(*dailies: DataFrame, processed_at: datetime | None = None) -> DataFrame:
    """Union of day tables with rates; what a feed does not report stays NULL. Unsorted."""
    stamp = F.lit(processed_at) if processed_at else F.current_timestamp()
    return _stacked(dailies, "null").withColumns(
        {
            "mortality_rate": guarded_pct(F.col("total_deaths"), F.col("total_cases")),
            "recovery_rate": guarded_pct(F.col("total_recovered"), F.col("total_cases")),
            "processed_at": stamp.cast("timestamp"),
        }
    )


def combine_daily_zero(*dailies: DataFrame) -> DataFrame:
    """Union of day tables where unreported measures read 0 and the date is text.

    Zero makes means and minima of unreported measures wrong; prefer :func:`combine_daily`.
    """
    totals = [c for c in ZERO_FORM if c.startswith("total_")]
    return (
        _stacked(dailies, "0")
        .na.fill(0, totals)
        .withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        .select(*ZERO_FORM)
    )


def with_hospital_rates(combined: DataFrame) -> DataFrame:
    """Adds hospitalizations per case and intensive care per hospitalization, in percent."""
    return combined.withColumns(
        {
            "hospitalization_rate": guarded_pct(
                F.col("total_hospitalizations"), F.col("total_cases")
            ),
            "icu_rate": guarded_pct(F.col("total_icu"), F.col("total_hospitalizations")),
        }
    )
