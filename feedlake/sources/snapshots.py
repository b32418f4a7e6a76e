"""Dated raw snapshots: ``<raw>/<feed>/<yyyy-MM-dd>/``.

The day is chosen from the names of the dated directories, before the scan is planned, so only
the chosen directory is listed and read however many days have landed.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from feedlake.feeds import Feed
from feedlake.sources.delimited import read_detected_csv
from feedlake.sources.quarantine import CheckedCsv, read_checked_csv

log = logging.getLogger(__name__)

# Fixed value: the name of a dated directory.
DATED = re.compile(r"\d{4}-\d{2}-\d{2}")


def snapshot_path(raw_root: str, feed: Feed, day: date | str) -> str:
    return f"{raw_root.rstrip('/')}/{feed.name}/{day}"


def snapshot_days(spark: SparkSession, raw_root: str, feed: Feed) -> list[str]:
    """The days that hold data, in order; works on any file system Spark can reach.

    A folder that a failed write left without a data file is no snapshot; one whose name is no
    day is logged.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{raw_root.rstrip('/')}/{feed.name}")
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    days = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if not DATED.fullmatch(name):
            log.warning("%s is not named after a day and is left out", entry.getPath())
        elif any(
            part.getLen() > 0 and part.getPath().getName()[0] not in "_."
            for part in files.listStatus(entry.getPath())
        ):
            days.append(name)
    return sorted(days)


def latest_snapshot(spark: SparkSession, raw_root: str, feed: Feed) -> str:
    """The greatest snapshot day; fails if none has landed."""
    days = snapshot_days(spark, raw_root, feed)
    if not days:
        raise FileNotFoundError(f"no snapshot of {feed.name} under {raw_root}")
    return days[-1]


def snapshot_day(
    spark: SparkSession, raw_root: str, feed: Feed, day: date | str | None = None
) -> str:
    """The day to read: the one named, which must have landed; else today's or the latest."""
    days = snapshot_days(spark, raw_root, feed)
    wanted = str(day or date.today())
    if wanted in days:
        return wanted
    if day is not None:
        raise FileNotFoundError(f"no snapshot of {feed.name} for {wanted} under {raw_root}")
    return latest_snapshot(spark, raw_root, feed)


def read_snapshot(
    spark: SparkSession,
    raw_root: str,
    feed: Feed,
    day: date | str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """The snapshot of :func:`snapshot_day`."""
    chosen = snapshot_day(spark, raw_root, feed, day)
    return read_detected_csv(spark, snapshot_path(raw_root, feed, chosen), encoding)


def read_checked_snapshot(
    spark: SparkSession,
    raw_root: str,
    feed: Feed,
    day: date | str | None = None,
    encoding: str = "UTF-8",
) -> CheckedCsv:
    """The snapshot of :func:`snapshot_day`, its broken lines set aside."""
    chosen = snapshot_day(spark, raw_root, feed, day)
    return read_checked_csv(spark, snapshot_path(raw_root, feed, chosen), encoding)


def inputs_present(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per named input: input, present (the path exists), files (with data, in the folder).

    A job that needs several inputs asks this before it starts, and tells all that are absent at
    once. Only names are looked at; hidden files and empty ones are no data.
    """
    context = spark.sparkContext
    rows = []
    for name, path in paths.items():
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(context._jsc.hadoopConfiguration())
        present, held = files.exists(at), 0
        if present:
            found = files.listFiles(at, True)
            while found.hasNext():
                entry = found.next()
                held += entry.getLen() > 0 and entry.getPath().getName()[0] not in "_."
        rows.append((name, present, held))
    return spark.createDataFrame(rows, "input string, present boolean, files bigint")
