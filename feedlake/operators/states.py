"""Partial day states of the feeds: what a day's row is made of, kept so that parts can be merged.

A state holds sums and counts, a sketch of the day's regions and the fingerprint of its rows. States
of several parts of a feed merge into the state of the whole, and those of a month's days into the
month's, without reading the feed again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import PARTS, fingerprint
from feedlake.operators.daily import PANEL_SUMS, STATUS_COUNTS, TOTAL_CATEGORIES

# A sketch of 2**12 registers counts with a relative standard error of 1.04 / 64.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

SUMS = (
    "rows", "total_cases", "total_hospitalizations", "total_icu", "total_deaths",
    "total_recovered", "active_cases", "age_sum", "aged",
)
"""Measures that add up; NULL where the feed does not report one."""


def _states(
    rows: DataFrame,
    day: str,
    region: str,
    measures: Mapping[str, Column],
    counted: Column | None = None,
) -> DataFrame:
    """States of the days of a formatted feed; only ``counted`` rows count, all are fingerprinted.

    Everything is one aggregation that combines on the map side, the sketch included.
    """
    hashed = [c for c in rows.columns if c != "ingestion_date"]
    counts = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    named = {name: measures.get(name, F.lit(None)).cast("bigint").alias(name) for name in SUMS}
    sketch = F.hll_sketch_agg(F.when(counts, F.col(region)), F.lit(SKETCH_BITS))
    return (
        rows.where(F.col(day).isNotNull())
        .groupBy(F.col(day).alias("date"), "country")
        .agg(*named.values(), sketch.alias("regions"), *fingerprint(hashed))
    )


def panel_states(panel: DataFrame, sums: Mapping[str, str] = PANEL_SUMS) -> DataFrame:
    """States of the panel's days, over its total category."""
    total = F.col("sex").isin(*TOTAL_CATEGORIES)
    measures = {name: F.sum(F.when(total, F.col(c))) for name, c in sums.items()}
    measures["rows"] = F.count_if(total)
    return _states(panel, "date", "department_code", measures, total)


def linelist_states(
    cases: DataFrame, status_counts: Mapping[str, str] = STATUS_COUNTS
) -> DataFrame:
    """States of the line list's days."""
    measures = {
        name: F.count_if(F.col("status") == status) for name, status in status_counts.items()
    }
    measures |= {
        "rows": F.count("*"),
        "total_cases": F.count("*"),
        "age_sum": F.sum("age"),
        "aged": F.count("age"),
    }
    return _states(cases, "report_date", "department_name", measures)


def merged(states: DataFrame, *keys: str | Column) -> DataFrame:
    """States with equal keys as one: sums and fingerprints add up, sketches are united."""
    sums = [F.sum(name).alias(name) for name in SUMS]
    prints = [F.sum(name).cast("decimal(38,0)").alias(name) for name in PARTS]
    return states.groupBy(*keys).agg(*sums, F.hll_union_agg("regions").alias("regions"), *prints)


def month_states(states: DataFrame) -> DataFrame:
    """States of a country's months."""
    return merged(states, F.trunc("date", "month").alias("month"), "country")


def all_time_states(states: DataFrame) -> DataFrame:
    """One state per country."""
    return merged(states, "country")


def estimated_regions(states: DataFrame) -> DataFrame:
    """The states with ``regions_count`` estimated from the sketch, which stays out."""
    count = F.hll_sketch_estimate("regions").alias("regions_count")
    return states.select(*[c for c in states.columns if c not in ("regions", *PARTS)], count)


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """Days whose rows differ between two sets of states, by count and fingerprint: date, country.

    A day that only one side has is changed. Both sides are small day tables, brought together by
    one aggregation.
    """
    marks = ["rows", *PARTS]
    kinds = [F.col(c).cast("decimal(38,0)").alias(c) for c in marks]

    def side(states: DataFrame, sign: int) -> DataFrame:
        return states.select("date", "country", F.lit(sign).alias("sign"), *kinds)

    both = side(before, -1).unionByName(side(after, 1)).groupBy("date", "country")
    apart = [F.sum(F.col(c) * F.col("sign")).alias(c) for c in marks]
    differs = F.col("sides") != 2
    for name in marks:
        differs = differs | (F.col(name) != 0)
    return both.agg(F.count("*").alias("sides"), *apart).where(differs).select("date", "country")
