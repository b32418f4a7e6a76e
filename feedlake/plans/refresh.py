"""Daily refresh: after a new snapshot only the months that differ are built again.

The states of all days (:mod:`feedlake.operators.states`) are kept by month beside the daily table.
A new snapshot's states are compared with them by fingerprints; months with a changed day are read,
combined and overwritten, the others are neither read for combining nor written. Stored states are
replaced last, so after a stop at any point the same months are found and built again.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.feeds import LINE_LIST, PANEL
from feedlake.operators.combine import combine_daily
from feedlake.operators.daily import linelist_daily, panel_daily
from feedlake.operators.states import changed_days, linelist_states, panel_states
from feedlake.plans.files import Store
from feedlake.plans.jobs import Lake
from feedlake.plans.shared import discard, settle
from feedlake.sinks import write_partitioned

DAILY = "daily_by_month"
STATES = "day_states"


def stored(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """A table kept by month, without its folder columns; None before the first refresh."""
    path = lake.usage(table)
    if not any(name.startswith("year=") for name in Store(spark, path).names(path)):
        return None
    return spark.read.parquet(path).drop("year", "month")


def ranges(months: list[date]) -> list[tuple[date, date]]:
    """Months as ranges of days, the end excluded; neighbours are joined."""
    out: list[tuple[date, date]] = []
    for first in sorted(months):
        end = date(first.year + first.month // 12, first.month % 12 + 1, 1)
        if out and out[-1][1] == first:
            out[-1] = out[-1][0], end
        else:
            out.append((first, end))
    return out


def within(day: str, spans: list[tuple[date, date]]) -> Column:
    """A test of days that reaches the scan, as it compares a stored column with dates."""
    test = F.lit(False)
    for first, end in spans:
        test = test | ((F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(end)))
    return test


def refresh_daily(
    spark: SparkSession, lake: Lake, processed_at: datetime | None = None
) -> dict:
    """Brings the daily table by month up to the formatted feeds; tells the months rebuilt.

    The months, not their rows, pass through the driver. A month whose days have all gone loses its
    folder.
    """
    panel = spark.read.parquet(lake.formatted(PANEL))
    cases = spark.read.parquet(lake.formatted(LINE_LIST))
    now = settle(panel_states(panel).unionByName(linelist_states(cases)), "day_states")
    before = stored(spark, lake, STATES)
    changed = (now.select("date") if before is None else changed_days(before, now)).select(
        F.trunc("date", "month").alias("month")
    )
    months = [r["month"] for r in changed.distinct().collect()]
    if months:
        spans = ranges(months)
        daily = combine_daily(
            panel_daily(panel.where(within("date", spans))),
            linelist_daily(cases.where(within("report_date", spans))),
            processed_at=processed_at,
        )
        states = now.where(within("date", spans))
        # A day without a row of the total category has a state, but no daily row.
        for table, rows, held in (
            (DAILY, daily, states.where("rows > 0")),
            (STATES, states, states),
        ):
            path = lake.usage(table)
            write_partitioned(rows, path)
            left = held.select(F.trunc("date", "month").alias("month")).distinct().collect()
            for month in set(months) - {r["month"] for r in left}:
                Store(spark, path).delete(f"{path}/year={month.year}/month={month.month}")
    discard(now)
    return {"path": lake.usage(DAILY), "months": sorted(str(m)[:7] for m in months)}
