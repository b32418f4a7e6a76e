"""Queries over repeated, partial and broken deliveries: what is left behind by the safe forms."""

from __future__ import annotations

from datetime import date

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
from feedlake.operators.quality import Cleaning
from feedlake.operators.states import (
    SKETCH_ERROR,
    all_time_states,
    estimated_regions,
    month_states,
)
from feedlake.plans.jobs import Lake, format_snapshot, land
from feedlake.plans.refresh import DAILY, STATES, refresh_daily, stored
from feedlake.plans.shared import scratch_path, settle
from feedlake.sinks import (
    append_batch,
    checked_documents,
    land_snapshot,
    ledger,
    move_batch,
    read_rejected,
    reconcile,
    stage_batch,
    write_checked_bulk,
    write_csv,
    write_table,
)
from feedlake.sources import (
    capped,
    infer_types,
    inputs_present,
    read_checked_csv,
    read_detected_csv,
    read_inferred_csv,
)

DAY = "2024-01-31"
# Months that the second delivery of the refresh changes.
CHANGED = ("1996-03", "1997-07")


def _formatted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ingested = date(2024, 1, 31)
    return (
        format_feed(panel_raw(spark, sf_dir), PANEL, PANEL_COUNTRY, ingested),
        format_feed(linelist_raw(spark, sf_dir), LINE_LIST, LINE_LIST_COUNTRY, ingested),
    )


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel, cases = _formatted(spark, sf_dir)
    return combine_daily(panel_daily(panel), linelist_daily(cases)).drop("processed_at")


def _appended(spark: SparkSession, sf_dir: str) -> str:
    """A table of two batches, the second stopped after its first file; both are sent twice."""
    path = scratch_path(spark, "appended")
    daily = settle(_combined(spark, sf_dir), "combined")
    early, late = daily.where("year(date) <= 1997"), daily.where("year(date) > 1997")
    append_batch(early, path, "early")
    stage_batch(late, path, "late")
    move_batch(spark, path, "late", at_most=1)
    for _ in range(2):
        append_batch(early, path, "early")
        append_batch(late, path, "late")
    return path


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days per month of a table whose batches were sent again and stopped on the way."""
    months = spark.read.parquet(_appended(spark, sf_dir)).groupBy("year", "month")
    return months.agg(F.count("*").alias("days"))


def append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that are wholly in the table, with their rows."""
    return ledger(spark, _appended(spark, sf_dir)).select("batch", "rows")


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[Lake, list[str]]:
    """A lake refreshed twice; the first delivery lacks rows of one month and differs in another."""
    lake = Lake(scratch_path(spark, "lake"))
    panel, cases = _formatted(spark, sf_dir)
    month = F.date_format("date", "yyyy-MM")
    first = panel.where((month != CHANGED[0]) | (F.col("department_code") != "1")).withColumn(
        "deaths", F.when(month == CHANGED[1], F.col("deaths") + 1).otherwise(F.col("deaths"))
    )
    write_table(cases, lake.formatted(LINE_LIST))
    write_table(first, lake.formatted(PANEL))
    refresh_daily(spark, lake)
    write_table(panel, lake.formatted(PANEL))
    return lake, refresh_daily(spark, lake)["months"]


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table after a delivery that changes two months."""
    lake, _ = _refreshed(spark, sf_dir)
    return stored(spark, lake, DAILY).drop("processed_at")


def refresh_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that the second refresh built again, with the days they have now."""
    lake, months = _refreshed(spark, sf_dir)
    month = F.date_format("date", "yyyy-MM").alias("month")
    days = stored(spark, lake, DAILY).groupBy(month).agg(F.count("*").alias("days"))
    return days.where(F.col("month").isin(months))


def regions_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions per month from stored sketches, held against the exact count of the feed.

    ``month`` is NULL for all time. An estimate may be off by four standard errors, and by one where
    that is less than a region.
    """
    lake = Lake(scratch_path(spark, "lake"))
    panel, cases = _formatted(spark, sf_dir)
    write_table(panel, lake.formatted(PANEL))
    write_table(cases, lake.formatted(LINE_LIST))
    refresh_daily(spark, lake)
    states = stored(spark, lake, STATES)
    months = estimated_regions(month_states(states)).select("month", "country", "regions_count")
    ever = estimated_regions(all_time_states(states)).select(
        F.lit(None).cast("date").alias("month"), "country", "regions_count"
    )
    estimates = months.unionByName(ever)

    def exact(rows: DataFrame, day: str, region: str) -> DataFrame:
        dated = rows.where(F.col(day).isNotNull())
        month = F.trunc(day, "month").alias("month")
        count = F.count_distinct(region).alias("regions")
        return dated.groupBy(month, "country").agg(count).unionByName(
            dated.groupBy(F.lit(None).cast("date").alias("month"), "country").agg(count)
        )

    counted = exact(panel.where("sex in ('ALL', '0')"), "date", "department_code").unionByName(
        exact(cases, "report_date", "department_name")
    )
    same = counted["month"].eqNullSafe(estimates["month"]) & (
        counted["country"] == estimates["country"]
    )
    apart = F.abs(F.col("regions_count") - F.col("regions"))
    bound = F.greatest(F.lit(1.0), F.col("regions") * (4 * SKETCH_ERROR))
    return counted.join(estimates, same).select(
        counted["month"], counted["country"], "regions", (apart <= bound).alias("within_error")
    )


def source_cap_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap that ends within a group of equal keys, found by refinement."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return capped(events, 700, ("event_type",), few=100)


def source_cap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap over several ranges of a key with two columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_orderkey", "l_linenumber"
    )
    return capped(lines, 4000, ("l_shipdate", "l_orderkey"), few=100)


def _broken_panel(spark: SparkSession, sf_dir: str) -> str:
    """The panel as text with surplus cells, missing cells and quotes that are never closed."""
    cells = ("dep", "sexe", "jour", "hosp", "rea", "rad", "dc")
    line = F.concat_ws(";", *cells)
    broken = (
        F.when((F.col("rad") == "7"), F.concat(line, F.lit(";more")))
        .when((F.col("rad") == "8"), F.concat_ws(";", *cells[:5]))
        .when((F.col("rad") == "9"), F.concat(F.lit('"'), line))
        .when((F.col("rad") == "10"), F.concat_ws(";", *cells[:6], F.lit('"open')))
        .when((F.col("rad") == "11"), F.concat_ws(";", F.lit('"1;1"'), *cells[1:]))
        .otherwise(line)
    )
    path = scratch_path(spark, "broken")
    rows = panel_raw(spark, sf_dir).select(broken.alias(";".join(cells)))
    plain = rows.write.option("header", True).option("sep", "\x01").option("quote", "\x02")
    plain.option("escapeQuotes", False).csv(path)
    return path


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sound rows of a broken panel, formatted."""
    checked = read_checked_csv(spark, _broken_panel(spark, sf_dir))
    return format_feed(checked.rows, PANEL, PANEL_COUNTRY).drop("ingestion_date")


def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines set aside, why, and how often each occurs."""
    rejects = read_checked_csv(spark, _broken_panel(spark, sf_dir)).rejects
    return rejects.groupBy("line", "reason").agg(F.count("*").alias("n"))


def _large_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined table with deaths so large that some are beyond 32 bits."""
    large = F.col("total_deaths") * 100_000_000
    return _combined(spark, sf_dir).withColumn("total_deaths", large)


def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that an index would refuse, from the file they were written to."""
    path = scratch_path(spark, "index")
    documents = checked_documents(_large_totals(spark, sf_dir))
    write_checked_bulk(documents, path, "daily-comparison")
    return read_rejected(spark, path).select(
        F.get_json_object("document", "$.country").alias("country"),
        F.get_json_object("document", "$.date").alias("date"),
        F.array_join("problems", ", ").alias("problems"),
    )


def accepted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per country, written and rejected."""
    path = scratch_path(spark, "index")
    write_checked_bulk(
        checked_documents(_large_totals(spark, sf_dir)), path, "daily-comparison"
    )
    country = F.get_json_object("value", "$.country")
    written = spark.read.text(f"{path}/bulk").where(country.isNotNull())
    refused = F.get_json_object("document", "$.country")
    both = written.select(country.alias("country"), F.lit(0).alias("refused")).unionByName(
        read_rejected(spark, path).select(refused.alias("country"), F.lit(1).alias("refused"))
    )
    return both.groupBy("country").agg(
        F.count_if(F.col("refused") == 0).alias("written"),
        F.count_if(F.col("refused") == 1).alias("rejected"),
    )


def sink_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written copy in which one day of one country has another value: counts do not show it."""
    source = settle(_combined(spark, sf_dir), "combined")
    path = scratch_path(spark, "copy")
    last = source.where(F.col("country") == PANEL_COUNTRY).agg(F.max("date")).scalar()
    changed = (F.col("country") == PANEL_COUNTRY) & (F.col("date") == last)
    deaths = F.when(changed, F.col("total_deaths") + 1).otherwise(F.col("total_deaths"))
    write_csv(source.withColumn("total_deaths", deaths), path)
    copy = spark.read.option("header", True).schema(source.schema).csv(path)
    return reconcile(source, copy, values=True)


def _written_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as CSV, a column for each kind of text."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    path = scratch_path(spark, "orders_csv")
    table(spark, sf_dir, "orders").select(
        key.alias("key"),
        (key + F.lit(5_000_000_000)).alias("wide"),
        (key / 4).cast("decimal(20,2)").alias("real"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.when(key % 2 == 0, "true").otherwise("false").alias("truth"),
        F.when(key % 50 == 0, "n/a").otherwise(key.cast("string")).alias("mixed"),
        F.when(key % 3 != 0, key.cast("string")).alias("gaps"),
        F.lit(None).cast("string").alias("empty"),
    ).write.option("header", True).option("sep", ";").csv(path)
    return path


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found in a text scan."""
    return infer_types(read_detected_csv(spark, _written_orders(spark, sf_dir)))


def inferred_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text read with those types."""
    rows = read_inferred_csv(spark, _written_orders(spark, sf_dir))
    return rows.select("key", "wide", "real", "day", "truth", "mixed", "gaps")


def _cleaned(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict]:
    """The line list with a tenth of its rows delivered twice, formatted under all rules."""
    lake = Lake(scratch_path(spark, "lake"))
    raw = linelist_raw(spark, sf_dir)
    twice = raw.unionByName(raw.where("id_de_caso % 10 = 0"))
    slashed = F.regexp_replace("fecha_reporte_web", r"^(\d{4})-(\d\d)-(\d\d) .*", "$3/$2/$1")
    land(twice.withColumn("fecha_reporte_web", slashed), lake, LINE_LIST, DAY)
    rules = Cleaning(
        date_formats=("dd/MM/yyyy",),
        ranges={"age": (0, 120)},
        nulls="drop",
        null_columns=("age", "status"),
        remove_duplicates=True,
    )
    return lake, format_snapshot(spark, lake, LINE_LIST, LINE_LIST_COUNTRY, DAY, cleaning=rules)


def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted cases after all rules of quality."""
    lake, _ = _cleaned(spark, sf_dir)
    return spark.read.parquet(lake.formatted(LINE_LIST)).drop("ingestion_date")


def cleaning_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job says each rule left out."""
    _, details = _cleaned(spark, sf_dir)
    counts = {"rows_in": details["rows_in"], "rows_out": details["rows_out"]}
    return spark.createDataFrame(
        list((counts | details["left_out"]).items()), "rule string, rows bigint"
    )


def inputs_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which inputs of the combination are there when only the panel has been landed."""
    lake = Lake(scratch_path(spark, "lake"))
    land_snapshot(panel_raw(spark, sf_dir), lake.raw, PANEL, DAY)
    found = inputs_present(
        spark,
        {
            "raw panel": f"{lake.raw}/{PANEL.name}/{DAY}",
            "raw line list": f"{lake.raw}/{LINE_LIST.name}/{DAY}",
            "formatted panel": lake.formatted(PANEL),
        },
    )
    return found.select("input", "present", (F.col("files") > 0).alias("has_data"))


DELIVERIES = {
    "append_batches": append_batches,
    "append_ledger": append_ledger,
    "daily_refresh": daily_refresh,
    "refresh_months": refresh_months,
    "regions_by_month": regions_by_month,
    "source_cap_ties": source_cap_ties,
    "source_cap_ranges": source_cap_ranges,
    "quarantine_rows": quarantine_rows,
    "quarantine_lines": quarantine_lines,
    "rejected_documents": rejected_documents,
    "accepted_documents": accepted_documents,
    "sink_fingerprint": sink_fingerprint,
    "inferred_types": inferred_types,
    "inferred_rows": inferred_rows,
    "cleaned_rows": cleaned_rows,
    "cleaning_counts": cleaning_counts,
    "inputs_exist": inputs_exist,
}
