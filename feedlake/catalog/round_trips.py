"""Queries that write through the sinks and jobs and return what is read back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.catalog.derived import (
    LINE_LIST_COUNTRY,
    PANEL_COUNTRY,
    linelist_raw,
    panel_raw,
    table,
)
from feedlake.feeds import LINE_LIST, PANEL
from feedlake.operators.combine import combine_daily
from feedlake.operators.daily import linelist_daily, panel_daily
from feedlake.operators.formatting import format_feed
from feedlake.operators.quality import FeedRejected, require_headers, warn_if_unexpected
from feedlake.operators.reports import summary_stats
from feedlake.operators.trend import (
    fit_trend,
    predict_days,
    trend_features,
    trend_metrics,
    trend_split,
)
from feedlake.plans.jobs import (
    Lake,
    combine,
    format_snapshot,
    index,
    land,
    model_trend,
    run_pipeline,
)
from feedlake.plans.shared import scratch_path, settle
from feedlake.sinks import (
    land_snapshot,
    to_documents,
    write_bulk,
    write_csv,
    write_metrics,
    write_partitioned,
)
from feedlake.sources import read_daily_csv, read_detected_csv, read_snapshot, read_text_csv

DAY = "2024-01-31"
STAMP = datetime(2024, 1, 31, 12)


def _combined(spark: SparkSession, sf_dir: str, stamp: datetime | None = None) -> DataFrame:
    panel = format_feed(panel_raw(spark, sf_dir), PANEL, PANEL_COUNTRY)
    cases = format_feed(linelist_raw(spark, sf_dir), LINE_LIST, LINE_LIST_COUNTRY)
    return combine_daily(panel_daily(panel), linelist_daily(cases), processed_at=stamp)


def _landed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(scratch_path(spark, "lake"))
    for feed, country, raw in (
        (PANEL, PANEL_COUNTRY, panel_raw),
        (LINE_LIST, LINE_LIST_COUNTRY, linelist_raw),
    ):
        land(raw(spark, sf_dir), lake, feed, DAY)
        format_snapshot(spark, lake, feed, country, DAY)
    combine(spark, lake)
    return lake


def snapshot_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a day the newest snapshot that holds data is read: the last folder is empty."""
    root = scratch_path(spark, "raw")
    raw = panel_raw(spark, sf_dir)
    land_snapshot(raw.where("sexe = '1'"), root, PANEL, "2024-01-01")
    land_snapshot(raw.where("sexe = '0'"), root, PANEL, "2024-01-02")
    context = spark.sparkContext
    empty = context._jvm.org.apache.hadoop.fs.Path(f"{root}/{PANEL.name}/2024-02-01")
    empty.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(empty)
    read = read_snapshot(spark, root, PANEL)
    return read.groupBy("sexe", "dep").agg(F.count("*").alias("rows_read"))


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with line breaks come back as one row each, the break replaced."""
    root = scratch_path(spark, "raw")
    broken = F.when(F.col("sexe") == "0", F.concat("dep", F.lit("\nend"))).otherwise(F.col("dep"))
    land_snapshot(panel_raw(spark, sf_dir).withColumn("dep", broken), root, PANEL, DAY)
    return read_snapshot(spark, root, PANEL, DAY).select("dep", "jour", "hosp")


def metrics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend's metrics as read from their file."""
    series = _combined(spark, sf_dir).select("date", "country", "total_hospitalizations")
    train, test = trend_split(trend_features(settle(series, "series"), country=PANEL_COUNTRY))
    path = scratch_path(spark, "metrics")
    write_metrics(trend_metrics(predict_days(fit_trend(train), test)), path)
    written = spark.read.schema("rmse double, r2 double").json(path)
    return written.select(F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


def summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary through its single CSV file."""
    summary = summary_stats(_combined(spark, sf_dir))
    path = scratch_path(spark, "summary_csv")
    write_csv(summary, path, single_file=True)
    return spark.read.option("header", True).schema(summary.schema).csv(path)


def bulk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of the bulk files and of the mapping file, with how often each occurs."""
    path = scratch_path(spark, "index")
    documents = to_documents(_combined(spark, sf_dir).drop("processed_at"))
    write_bulk(documents, path, "daily-comparison")
    lines = spark.read.text([f"{path}/bulk", f"{path}/mapping"])
    return lines.groupBy("value").agg(F.count("*").alias("n"))


def pipeline_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast left behind by the trend job."""
    lake = _landed_lake(spark, sf_dir)
    model_trend(spark, lake, PANEL_COUNTRY)
    return spark.read.parquet(lake.usage("trend_forecast"))


def pipeline_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per country left behind by the index job."""
    lake = _landed_lake(spark, sf_dir)
    path = index(spark, lake)["path"]
    country = F.get_json_object("value", "$.country")
    lines = spark.read.text(f"{path}/bulk").where(country.isNotNull())
    return lines.groupBy(country.alias("country")).agg(F.count("*").alias("documents"))


def stage_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order with its outcome and the rows it counted."""
    lake = Lake(scratch_path(spark, "lake"))
    feeds = panel_raw(spark, sf_dir), linelist_raw(spark, sf_dir)
    results = run_pipeline(spark, lake, *feeds, PANEL_COUNTRY, LINE_LIST_COUNTRY, DAY)
    counts = ("rows", "rows_out", "documents")
    rows = [
        (k, r.name, r.ok, next((r.details[c] for c in counts if c in r.details), None))
        for k, r in enumerate(results)
    ]
    return spark.createDataFrame(rows, "position int, stage string, ok boolean, counted bigint")


def header_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks on names say of both feeds, whole and with columns taken away."""
    panel, cases = panel_raw(spark, sf_dir), linelist_raw(spark, sf_dir)
    tried = {
        "panel": (panel, PANEL),
        "panel without rea": (panel.drop("rea"), PANEL),
        "cases": (cases, LINE_LIST),
        "cases without dates": (cases.drop("fecha_reporte_web"), LINE_LIST),
        "cases without places": (cases.drop("departamento", "departamento_nom"), LINE_LIST),
    }
    out = None
    for name, (df, feed) in tried.items():
        try:
            require_headers(df, feed)
            outcome = "accepted"
        except FeedRejected as refusal:
            outcome = str(refusal)
        renamed = df.withColumnsRenamed(dict(feed.renames)).withColumn("country", F.lit(""))
        row = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("feed"),
            F.lit(outcome).alias("outcome"),
            F.lit(warn_if_unexpected(renamed, feed)).alias("as_expected"),
            "rows",
        )
        out = row if out is None else out.unionByName(row)
    return out


def encoded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases written in another encoding and read back with it."""
    path = scratch_path(spark, "latin")
    cases = linelist_raw(spark, sf_dir).select(
        "id_de_caso", F.concat("departamento_nom", F.lit(" á")).alias("departamento_nom")
    )
    cases.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return read_detected_csv(spark, path, encoding="ISO-8859-1")


def fallback_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quoted header full of commas misleads the detection; the next separator is used."""
    path = scratch_path(spark, "misleading")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key,of,order"), "o_orderstatus"
    )
    orders.write.option("header", True).option("sep", ";").option("quoteAll", True).csv(path)
    return read_detected_csv(spark, path).toDF("order_key", "status")


def inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV copy read with inferred types."""
    path = scratch_path(spark, "daily_csv")
    write_csv(_combined(spark, sf_dir, STAMP), path)
    read = read_daily_csv(spark, path, infer=True)
    return read.select(
        F.col("date").cast("date").alias("date"),
        "country",
        F.col("total_deaths").cast("bigint").alias("total_deaths"),
        "mortality_rate",
        F.lit(dict(read.dtypes)["total_deaths"]).alias("inferred_as"),
    )


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per ingestion date and per processing time, both given."""
    cases = format_feed(
        linelist_raw(spark, sf_dir), LINE_LIST, LINE_LIST_COUNTRY, date(2024, 1, 31)
    )
    ingested = cases.groupBy(F.col("ingestion_date").cast("string").alias("stamp"))
    processed = _combined(spark, sf_dir, STAMP).groupBy(
        F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    )
    count = F.count("*").alias("n")
    return ingested.agg(count).unionByName(processed.agg(count))


def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days per month after one write, an append of one year and an overwrite of another."""
    path = scratch_path(spark, "by_month")
    daily = settle(_combined(spark, sf_dir).drop("processed_at"), "combined")
    write_partitioned(daily, path)
    write_partitioned(daily.where("year(date) = 1994"), path, mode="append")
    write_partitioned(daily.where("year(date) = 1995 and country = 'PANEL'"), path)
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count("*").alias("days"))


def sorted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part file of the daily CSV copy, in order: its rows are in key order."""
    lake = _landed_lake(spark, sf_dir)
    read = read_text_csv(spark, lake.usage("daily_comparison_csv"))
    lines = read.select(
        "date", "country", F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_name").alias("file"),
    )
    parts = lines.groupBy("file").agg(
        F.min(F.struct("date", "country")).alias("low"),
        F.min_by(F.struct("date", "country"), "at").alias("first"),
        F.count("*").alias("n"),
    )
    return parts.agg(
        F.sum("n").alias("rows"), F.bool_and(F.col("low") == F.col("first")).alias("in_order")
    )


ROUND_TRIPS = {
    "snapshot_fallback": snapshot_fallback,
    "landing_lines": landing_lines,
    "metrics_file": metrics_file,
    "summary_csv": summary_csv,
    "bulk_files": bulk_files,
    "pipeline_trend": pipeline_trend,
    "pipeline_index": pipeline_index,
    "stage_results": stage_results,
    "header_checks": header_checks,
    "encoded_scan": encoded_scan,
    "fallback_scan": fallback_scan,
    "inferred_scan": inferred_scan,
    "stamped": stamped,
    "partitioned_append": partitioned_append,
    "sorted_csv": sorted_csv,
}
