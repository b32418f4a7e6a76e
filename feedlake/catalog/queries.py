"""One entry per operator: ``(spark, sf_dir) -> DataFrame``.

Columns that differ from run to run (``ingestion_date``, ``processed_at``) are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.catalog.deliveries import DELIVERIES
from feedlake.catalog.round_trips import ROUND_TRIPS
from feedlake.catalog.derived import (
    LINE_LIST_COUNTRY,
    PANEL_COUNTRY,
    linelist_raw,
    panel_raw,
    table,
)
from feedlake.feeds import COMBINED_SCHEMA, LINE_LIST, PANEL
from feedlake.functions import first_date
from feedlake.operators.combine import (
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
from feedlake.operators.formatting import format_feed, typed_feed
from feedlake.operators.quality import (
    dedupe_rows,
    handle_nulls,
    null_counts,
    quality_report,
    range_filter,
)
from feedlake.operators.reports import (
    country_stats,
    current_stats,
    first_rows,
    monthly_totals,
    overall_stats,
    region_totals,
    series_by_country,
    summary_stats,
)
from feedlake.operators.trend import (
    fit_trend,
    trend_coefficients,
    predict_days,
    trend_features,
    trend_forecast,
    trend_metrics,
    trend_split,
)
from feedlake.plans.jobs import Lake, combine, format_snapshot, land
from feedlake.plans.shared import scratch_path, settle
from feedlake.sinks import (
    ZERO_INDEX_FIELDS,
    bulk_lines,
    land_snapshot,
    reconcile,
    to_documents,
    write_csv,
    write_partitioned,
    write_table,
)
from feedlake.sources import capped, read_daily_csv, read_snapshot

LANDING_DAY = "2024-01-31"


def panel_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_feed(panel_raw(spark, sf_dir), PANEL, PANEL_COUNTRY).drop("ingestion_date")


def linelist_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_feed(linelist_raw(spark, sf_dir), LINE_LIST, LINE_LIST_COUNTRY)
    return formatted.drop("ingestion_date")


def panel_daily_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_daily(panel_format(spark, sf_dir))


def panel_daily_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built from every row: the form that adds up all categories does not filter."""
    return panel_daily(typed_feed(panel_raw(spark, sf_dir), PANEL, PANEL_COUNTRY), categories=None)


def panel_daily_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-measure panel table, written and read back."""
    daily = panel_daily(
        panel_format(spark, sf_dir), categories=("ALL",), sums=PANEL_BRIEF_SUMS, regions=False
    )
    return settle(daily, "panel_daily_brief")


def linelist_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linelist_daily(linelist_format(spark, sf_dir))


def linelist_daily_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = settle(linelist_cells(linelist_format(spark, sf_dir)), "linelist_cells")
    return linelist_daily_joined(cells)


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = combine_daily(panel_daily_total(spark, sf_dir), linelist_daily_counts(spark, sf_dir))
    return daily.drop("processed_at")


def combine_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_hospital_rates(combined(spark, sf_dir)).select(
        "date", "country", "mortality_rate", "recovery_rate", "hospitalization_rate", "icu_rate"
    )


def combine_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_daily_zero(
        panel_daily_all(spark, sf_dir), linelist_daily_counts(spark, sf_dir)
    )


def country_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_by_country(
        combined(spark, sf_dir),
        countries={PANEL_COUNTRY: "panel", LINE_LIST_COUNTRY: "linelist"},
        measures={"total_deaths": "deaths", "total_cases": "cases"},
    )


def daily_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(
        combined(spark, sf_dir), 10, ("date", "country"), ("date", "country", "total_deaths")
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(panel_raw(spark, sf_dir), PANEL, PANEL_COUNTRY).unionByName(
        quality_report(linelist_raw(spark, sf_dir), LINE_LIST, LINE_LIST_COUNTRY)
    )


def key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(linelist_format(spark, sf_dir), ("report_date", "case_id", "age"))


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with every tenth one delivered twice."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return dedupe_rows(orders.unionByName(orders.where("o_orderkey % 10 = 0")))


def plausible_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_filter(linelist_format(spark, sf_dir).select("case_id", "age"), "age")


def nulls_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = linelist_format(spark, sf_dir).select("case_id", "age", "status")
    return handle_nulls(cases, "fill", ("age", "status"))


def nulls_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = linelist_format(spark, sf_dir).select("case_id", "age")
    return handle_nulls(cases, "drop", ("case_id", "age"))


def date_multiformat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days written in three notations, and every fourth one in none."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    written = (
        F.when(key % 4 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 4 == 2, F.date_format(day, "yyyy/MM/dd"))
        .otherwise("not a date")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", first_date(written).alias("parsed_date")
    )


def source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return capped(events, 100, ("event_id",))


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the newest month; the filter on the stored column reaches the scan."""
    orders = table(spark, sf_dir, "orders")
    newest = orders.agg(F.trunc(F.max("o_orderdate"), "month").cast("timestamp_ntz")).scalar()
    return orders.where(F.col("o_orderdate") >= newest).select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("snapshot")
    )


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_documents(combined(spark, sf_dir), keep=("country", "date"))


def index_documents_dag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine-field documents of the zero-filled table."""
    zero = combine_zero(spark, sf_dir)
    return to_documents(zero, "zero", ZERO_INDEX_FIELDS, keep=("country", "date"))


def feed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first cases with the feed's display columns."""
    cases = linelist_format(spark, sf_dir)
    return first_rows(cases, 5, ("report_date", "case_id"), LINE_LIST.display)


def feed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of the formatted case table, with the rows that have a value."""
    cases = linelist_format(spark, sf_dir)
    counts = cases.agg(*[F.count(c).alias(c) for c in cases.columns])
    described = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col(name).alias("present")
            )
            for name, kind in cases.dtypes
        ]
    )
    return counts.select(F.inline(described))


def index_documents_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_documents(combined(spark, sf_dir), "zero", keep=("country", "date"))


def bulk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = to_documents(combined(spark, sf_dir))
    return bulk_lines(documents, "daily-comparison").withColumnRenamed("value", "lines")


def sink_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined table against what reading its written copy gives; one scan of the feeds."""
    source = settle(combined(spark, sf_dir), "combined")
    path = scratch_path(spark, "daily_comparison")
    write_table(source, path)
    return reconcile(source, spark.read.parquet(path))


def usage_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined table through its CSV directory, all part files, with its schema."""
    path = scratch_path(spark, "daily_comparison_csv")
    write_csv(combined(spark, sf_dir), path)
    schema = T.StructType([f for f in COMBINED_SCHEMA.fields if f.name != "processed_at"])
    return read_daily_csv(spark, path, schema)


def partitioned_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days per year and month as found in the partition directories."""
    path = scratch_path(spark, "daily_by_month")
    write_partitioned(combined(spark, sf_dir), path)
    months = spark.read.parquet(path).groupBy("year", "month")
    return months.agg(F.count("*").alias("days"))


def panel_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel landed as CSV, its latest snapshot found, its separator detected, formatted."""
    raw_root = scratch_path(spark, "raw")
    land_snapshot(panel_raw(spark, sf_dir), raw_root, PANEL, LANDING_DAY, sep=";")
    return format_feed(read_snapshot(spark, raw_root, PANEL), PANEL, PANEL_COUNTRY).drop(
        "ingestion_date"
    )


def linelist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line list landed as CSV, read by its day and formatted."""
    raw_root = scratch_path(spark, "raw")
    land_snapshot(linelist_raw(spark, sf_dir), raw_root, LINE_LIST, LANDING_DAY)
    raw = read_snapshot(spark, raw_root, LINE_LIST, LANDING_DAY)
    return format_feed(raw, LINE_LIST, LINE_LIST_COUNTRY).drop("ingestion_date")


def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary table left behind by landing, formatting and combining."""
    lake = Lake(scratch_path(spark, "lake"))
    feeds = (
        (PANEL, PANEL_COUNTRY, panel_raw),
        (LINE_LIST, LINE_LIST_COUNTRY, linelist_raw),
    )
    for feed, country, raw in feeds:
        land(raw(spark, sf_dir), lake, feed, LANDING_DAY)
        format_snapshot(spark, lake, feed, country, LANDING_DAY)
    combine(spark, lake)
    return spark.read.parquet(lake.usage("summary_stats"))


def _settled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = panel_daily_total(spark, sf_dir)
    series = daily.select("date", "country", "total_hospitalizations")
    return trend_features(settle(series, "panel_series"), country=PANEL_COUNTRY)


def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = trend_split(_settled_features(spark, sf_dir))
    parts = train.select("day_number", F.lit("train").alias("part")).unionByName(
        test.select("day_number", F.lit("test").alias("part"))
    )
    return parts.groupBy("part").agg(
        F.count("*").alias("n"),
        F.min("day_number").alias("min_day"),
        F.max("day_number").alias("max_day"),
    )


def trend_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope and intercept in one aggregation over the day table."""
    train, _ = trend_split(_settled_features(spark, sf_dir))
    fit = trend_coefficients(train)
    return fit.select(
        F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept")
    )


def trend_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = trend_split(_settled_features(spark, sf_dir))
    metrics = trend_metrics(predict_days(fit_trend(train), test))
    return metrics.select(F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _settled_features(spark, sf_dir)
    train, _ = trend_split(features)
    return trend_forecast(fit_trend(train), features)


QUERIES = {
    "panel_format": panel_format,
    "linelist_format": linelist_format,
    "panel_daily": panel_daily_total,
    "panel_daily_all": panel_daily_all,
    "panel_daily_brief": panel_daily_brief,
    "linelist_daily": linelist_daily_counts,
    "linelist_daily_join": linelist_daily_join,
    "combine_daily": combined,
    "combine_rates": combine_rates,
    "combine_daily_zero": combine_zero,
    "summary_stats": lambda spark, sf_dir: summary_stats(combined(spark, sf_dir)),
    "country_stats": lambda spark, sf_dir: country_stats(combined(spark, sf_dir)),
    "monthly_totals": lambda spark, sf_dir: monthly_totals(combined(spark, sf_dir)),
    "series_by_country": country_series,
    "current_stats": lambda spark, sf_dir: current_stats(combined(spark, sf_dir)),
    "region_totals": lambda spark, sf_dir: region_totals(linelist_format(spark, sf_dir)),
    "daily_sample": daily_sample,
    "quality_report": quality,
    "null_counts": key_nulls,
    "dedupe_rows": deduped,
    "range_filter": plausible_ages,
    "null_fill": nulls_filled,
    "null_drop": nulls_dropped,
    "date_multiformat": date_multiformat,
    "source_cap": source_cap,
    "snapshot_latest": snapshot_latest,
    "panel_scan": panel_scan,
    "linelist_scan": linelist_scan,
    "usage_csv": usage_csv,
    "partitioned_usage": partitioned_usage,
    "pipeline_summary": pipeline_summary,
    "index_documents": index_documents,
    "index_documents_dag": index_documents_dag,
    "index_documents_zero": index_documents_zero,
    "bulk_index": bulk_index,
    "sink_reconcile": sink_reconcile,
    "trend_features": _settled_features,
    "trend_split": split_parts,
    "trend_fit": trend_fit,
    "trend_metrics": trend_quality,
    "trend_forecast": forecast,
    "overall_stats": lambda spark, sf_dir: overall_stats(combined(spark, sf_dir)),
    "feed_sample": feed_sample,
    "feed_schema": feed_schema,
    **ROUND_TRIPS,
    **DELIVERIES,
}
