"""Whole jobs: land, format, combine, model, index, and all of them in order.

Stages hand over written tables, so a stage can be run again on its own and no table is computed
twice. Each stage returns what it counted on the way.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from feedlake.feeds import LINE_LIST, PANEL, Feed
from feedlake.operators.combine import combine_daily, combine_daily_zero
from feedlake.operators.daily import linelist_daily, panel_daily
from feedlake.operators.formatting import format_feed, typed_feed
from feedlake.operators.quality import (
    Cleaning,
    clean,
    counted,
    require_headers,
    require_rows,
    require_types,
    warn_if_unexpected,
)
from feedlake.operators.reports import summary_stats
from feedlake.operators.trend import (
    fit_trend,
    predict_days,
    trend_features,
    trend_forecast,
    trend_metrics,
    trend_split,
)
from feedlake.sinks import (
    INDEX_FIELDS,
    ZERO_INDEX_FIELDS,
    checked_documents,
    land_snapshot,
    write_checked_bulk,
    write_csv,
    write_metrics,
    write_sorted,
    write_table,
)
from feedlake.sources import (
    read_checked_snapshot,
    read_snapshot,
    read_text_csv,
    snapshot_day,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lake:
    """Where the layers live; any path Spark can reach."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    def formatted(self, feed: Feed) -> str:
        return f"{self.root}/formatted/{feed.name}"

    def all_rows(self, feed: Feed) -> str:
        """The typed feed without the row filter, which the zero-filled form is built from."""
        return f"{self.root}/formatted/{feed.name}_all_rows"

    def quarantine(self, feed: Feed) -> str:
        """Lines of the last formatted snapshot that are no rows."""
        return f"{self.root}/formatted/{feed.name}_quarantine"

    def usage(self, table: str) -> str:
        return f"{self.root}/usage/{table}"


@dataclass
class StageResult:
    """Outcome of one stage."""

    name: str
    ok: bool
    seconds: float
    details: dict = field(default_factory=dict)
    error: str | None = None


def land(
    source: DataFrame, lake: Lake, feed: Feed, day: date | str | None = None
) -> dict:
    """Checks a raw feed and writes it as the snapshot of a day; every row must come back."""
    require_rows(source, feed.name)
    require_headers(source, feed)
    rows, landed = counted(source, f"{feed.name}_landed")
    path = land_snapshot(rows, lake.raw, feed, day)
    read_back = read_text_csv(source.sparkSession, path).count()
    if read_back != landed.get["rows"]:
        raise RuntimeError(f"{landed.get['rows']} rows were landed but {read_back} are read back")
    return {"path": path, "rows": read_back}


def format_snapshot(
    spark: SparkSession,
    lake: Lake,
    feed: Feed,
    country: str,
    day: date | str | None = None,
    ingestion_date: date | None = None,
    all_rows: bool = False,
    cleaning: Cleaning | None = None,
    quarantine: bool = False,
) -> dict:
    """Types and filters a snapshot into the formatted layer, counting rows on the way.

    A named day must have landed; without one it is today's or the latest. With ``all_rows`` the
    feed is typed but not filtered, into a table of its own. ``cleaning`` applies its rules to the
    typed rows and counts what each leaves out, under ``left_out``. With ``quarantine`` broken lines
    are not bent into rows but written beside the feed, with file and reason; every line is then
    either a row or in there.
    """
    chosen = snapshot_day(spark, lake.raw, feed, day)
    rules = cleaning or Cleaning()
    details = {}
    if quarantine:
        checked = read_checked_snapshot(spark, lake.raw, feed, chosen)
        raw = checked.rows
        write_table(checked.rejects, lake.quarantine(feed))
        details["quarantined"] = spark.read.parquet(lake.quarantine(feed)).count()
    else:
        raw = read_snapshot(spark, lake.raw, feed, chosen)
    form = typed_feed if all_rows else format_feed
    shape = form(raw, feed, country, ingestion_date, rules.date_formats)
    require_rows(shape, f"formatted {feed.name}")
    rows, rows_in = counted(raw, f"{feed.name}_in")
    formatted = form(rows, feed, country, ingestion_date, rules.date_formats)
    warn_if_unexpected(formatted, feed)
    require_types(formatted, feed)
    cleaned, left_out = clean(formatted, rules)
    kept, rows_out = counted(cleaned, f"{feed.name}_out")
    path = lake.all_rows(feed) if all_rows else lake.formatted(feed)
    write_table(kept, path)
    details |= {
        "path": path,
        "day": chosen,
        "rows_in": rows_in.get["rows"],
        "rows_out": rows_out.get["rows"],
    }
    if left_out:
        details["left_out"] = {rule: count.get["rows"] for rule, count in left_out.items()}
    return details


def combine(
    spark: SparkSession, lake: Lake, missing: str = "null", processed_at: datetime | None = None
) -> dict:
    """Builds the daily comparison once and derives the summary and the CSV copies from it.

    ``missing="zero"`` adds up every panel category, reads 0 for what a feed does not report and
    has no rates, hence no summary.
    """
    if missing not in ("null", "zero"):
        raise ValueError(f"unknown missing {missing!r}")
    panel = spark.read.parquet(
        lake.all_rows(PANEL) if missing == "zero" else lake.formatted(PANEL)
    )
    cases = spark.read.parquet(lake.formatted(LINE_LIST))
    daily_path = lake.usage("daily_comparison")
    if missing == "zero":
        daily = combine_daily_zero(panel_daily(panel, categories=None), linelist_daily(cases))
    else:
        daily = combine_daily(
            panel_daily(panel), linelist_daily(cases), processed_at=processed_at
        )
    write_sorted(daily, daily_path)
    written = spark.read.parquet(daily_path)
    write_csv(written, lake.usage("daily_comparison_csv"), keys=("date", "country"))
    # Counted from the written files: sorting runs its input twice, which an observation would add.
    details = {"path": daily_path, "rows": written.count()}
    if missing != "zero":
        summary = summary_stats(written)
        write_table(summary, lake.usage("summary_stats"))
        summary = spark.read.parquet(lake.usage("summary_stats"))
        write_csv(summary, lake.usage("summary_stats_csv"), single_file=True)
    return details


def model_trend(spark: SparkSession, lake: Lake, country: str) -> dict:
    """Fits and evaluates the trend of a country's hospitalizations and writes the forecast."""
    daily = spark.read.parquet(lake.usage("daily_comparison"))
    features = trend_features(daily, country=country)
    train, test = trend_split(features)
    require_rows(train, "training part")
    model = fit_trend(train)
    write_metrics(trend_metrics(predict_days(model, test)), lake.usage("trend_metrics"))
    write_table(trend_forecast(model, features), lake.usage("trend_forecast"))
    return {"slope": float(model.coefficients[0]), "intercept": float(model.intercept)}


def index(
    spark: SparkSession, lake: Lake, name: str = "daily-comparison", missing: str = "null"
) -> dict:
    """Writes the comparison as index documents, those an index would refuse apart, and counts."""
    daily = spark.read.parquet(lake.usage("daily_comparison"))
    fields = ZERO_INDEX_FIELDS if missing == "zero" else INDEX_FIELDS
    path = lake.usage("index")
    counts = write_checked_bulk(checked_documents(daily, missing, fields), path, name, fields=fields)
    return {"path": path, "documents": counts["written"], "rejected": counts["rejected"]}


def run_stages(stages: Mapping[str, Callable[[], dict]]) -> list[StageResult]:
    """Runs stages in order. A failure is recorded and the next stage still runs."""
    results = []
    for name, stage in stages.items():
        started = time.monotonic()
        try:
            details, error = stage(), None
        except Exception as failure:  # noqa: BLE001 - any failure belongs to its own stage
            log.exception("stage %s failed", name)
            details, error = {}, f"{type(failure).__name__}: {failure}"
        seconds = time.monotonic() - started
        results.append(StageResult(name, error is None, seconds, details, error))
    return results


def stages_after_landing(
    spark: SparkSession,
    lake: Lake,
    panel_country: str,
    linelist_country: str,
    day: date | str | None = None,
    missing: str = "null",
    cleaning: Mapping[str, Cleaning] | None = None,
    quarantine: bool = False,
) -> dict[str, Callable[[], dict]]:
    """Formatting to indexing, in order, over the snapshots in the lake.

    ``cleaning`` has the rules of feeds by their names.
    """
    rules = cleaning or {}
    return {
        "format_panel": lambda: format_snapshot(
            spark,
            lake,
            PANEL,
            panel_country,
            day,
            all_rows=missing == "zero",
            cleaning=rules.get(PANEL.name),
            quarantine=quarantine,
        ),
        "format_linelist": lambda: format_snapshot(
            spark,
            lake,
            LINE_LIST,
            linelist_country,
            day,
            cleaning=rules.get(LINE_LIST.name),
            quarantine=quarantine,
        ),
        "combine": lambda: combine(spark, lake, missing),
        "model_trend": lambda: model_trend(spark, lake, panel_country),
        "index": lambda: index(spark, lake, missing=missing),
    }


def run_pipeline(
    spark: SparkSession,
    lake: Lake,
    panel_raw: DataFrame,
    linelist_raw: DataFrame,
    panel_country: str,
    linelist_country: str,
    day: date | str | None = None,
    missing: str = "null",
) -> list[StageResult]:
    """Every stage from landing to indexing."""
    landing = {
        "land_panel": lambda: land(panel_raw, lake, PANEL, day),
        "land_linelist": lambda: land(linelist_raw, lake, LINE_LIST, day),
    }
    later = stages_after_landing(spark, lake, panel_country, linelist_country, day, missing)
    return run_stages(landing | later)
