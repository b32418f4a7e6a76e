"""Checks and clean-up steps.

Checks on names look at the schema only. Checks on rows either stop at the first row or ride along
with the pass that writes the table (:func:`counted`).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import and_, or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.feeds import Feed
from feedlake.functions.parsing import DATE_FORMATS
from feedlake.operators.formatting import row_is_kept, typed_feed

log = logging.getLogger(__name__)

# Fills for missing values, and the plausible ages.
FILL_INT = 0
FILL_TEXT = "UNKNOWN"
AGE_RANGE = (0, 120)


class FeedRejected(ValueError):
    """A feed or table does not meet its contract."""


def require_rows(df: DataFrame, what: str) -> None:
    """Fails on an empty table; reads no further than the first row."""
    if df.isEmpty():
        raise FeedRejected(f"{what} has no rows")


def require_headers(df: DataFrame, feed: Feed) -> None:
    """Fails when a raw snapshot lacks a required header or a header of a required kind."""
    absent = [c for c in feed.required if c not in df.columns]
    if absent:
        raise FeedRejected(f"{feed.name} lacks the columns {', '.join(absent)}")
    headers = [c.lower() for c in df.columns]
    for need, tokens in feed.required_tokens.items():
        if not any(token in header for header in headers for token in tokens):
            raise FeedRejected(f"{feed.name} has no {need} column")


def require_types(df: DataFrame, feed: Feed) -> None:
    """Fails when a formatted column has another type than the feed's contract says."""
    contract = {f.name: f.dataType for f in feed.formatted_schema.fields}
    wrong = [f.name for f in df.schema.fields if contract.get(f.name, f.dataType) != f.dataType]
    if wrong:
        raise FeedRejected(f"{feed.name} has other types than agreed in {', '.join(wrong)}")


def warn_if_unexpected(df: DataFrame, feed: Feed, at_least: int = 2) -> bool:
    """Warns, and returns False, when too few of the expected formatted columns exist."""
    found = [c for c in feed.expected if c in df.columns]
    as_expected = len(found) >= min(at_least, len(feed.expected))
    if not as_expected:
        log.warning("%s: expected %s, found only %s", feed.name, feed.expected, found)
    return as_expected


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows plus a row count that is filled in by the next action over them.

    Exact where the rows reach that action without a further shuffle, as in a write of the result:
    then each partition counts once even if tasks are run again.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def quality_report(
    raw: DataFrame, feed: Feed, country: str, ingestion_date: date | None = None
) -> DataFrame:
    """One row per feed: rows in, out and dropped, rows with a NULL key, and whether none is left.

    Rows in and out come from one pass, because the formatter's filter is evaluated as a column.
    """
    typed = typed_feed(raw, feed, country, ingestion_date)
    keys = [F.col(c) for c in feed.keys if c in typed.columns]
    any_key_null = reduce(or_, [key.isNull() for key in keys], F.lit(False))
    flags = typed.select(
        row_is_kept(typed, feed).alias("kept"),
        any_key_null.alias("key_missing"),
    )
    counts = flags.agg(
        F.count("*").alias("rows_in"),
        F.count_if("kept").alias("rows_out"),
        F.count_if("key_missing").alias("null_keys"),
    )
    return counts.select(
        F.lit(feed.name).alias("feed"),
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("rows_dropped"),
        "null_keys",
        (F.col("rows_out") == 0).alias("is_empty"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Each distinct row once. Copies collapse before the shuffle, so many copies cost little."""
    return df.dropDuplicates()


def deduped_and_counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Each distinct row once, with the number of copies left out, filled in by the next action.

    Copies are counted where they collapse, after the shuffle, so a task that is run again does not
    count twice.
    """
    copies = "_copies_of_row"
    # NULLs in a row are one value to a grouping, as to the removal of duplicates.
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias(copies))
    observation = Observation(name)
    left_out = F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("rows")
    return grouped.observe(observation, left_out).drop(copies), observation


@dataclass(frozen=True)
class Cleaning:
    """What a job does to formatted rows, in this order; nothing by default."""

    date_formats: tuple[str, ...] = ()
    """Notations of dates tried in order instead of the one that is always read."""
    ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    """Columns with the least and greatest value that is plausible; NULL passes."""
    nulls: str = "keep"
    """``keep``, ``fill`` or ``drop``, for the columns of ``null_columns``."""
    null_columns: tuple[str, ...] = ()
    remove_duplicates: bool = False


def published_cleaning(feed: Feed) -> Cleaning:
    """The settings that feeds are published with: rows need their keys, ages are plausible."""
    return Cleaning(
        date_formats=DATE_FORMATS,
        ranges={"age": AGE_RANGE} if "age" in feed.ints else {},
        nulls="drop",
        null_columns=feed.keys,
        remove_duplicates=True,
    )


def clean(df: DataFrame, rules: Cleaning) -> tuple[DataFrame, dict[str, Observation]]:
    """The rows that pass all rules, and per rule what counts the rows it left out.

    The counts of the range and of the NULL rule ride along as sums of flags; all are filled in by
    the next action. Only the removal of duplicates shuffles. A range of a column that the feed
    does not bring is passed over with a warning; columns whose NULLs count must be there.
    """
    if absent := [c for c in rules.null_columns if c not in df.columns]:
        raise FeedRejected(f"no columns {', '.join(absent)} to clean")
    counts: dict[str, Observation] = {}

    def leave_out(rows: DataFrame, rule: str, keeps: Column) -> DataFrame:
        counts[rule] = Observation(f"{rule}_{uuid4().hex}")
        left_out = F.count_if(~keeps).alias("rows")
        return rows.observe(counts[rule], left_out).where(keeps)

    for column, (low, high) in rules.ranges.items():
        if column not in df.columns:
            log.warning("no column %s to hold against its range", column)
            continue
        keeps = F.coalesce(in_range(column, low, high), F.lit(True))
        df = leave_out(df, f"out_of_range_{column}", keeps)
    if rules.nulls == "drop":
        if not rules.null_columns:
            raise ValueError("name the columns whose NULLs drop a row")
        present = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in rules.null_columns])
        df = leave_out(df, "null", present)
    else:
        df = handle_nulls(df, rules.nulls, rules.null_columns or None)
    if rules.remove_duplicates:
        df, counts["duplicates"] = deduped_and_counted(df, f"duplicates_{uuid4().hex}")
    return df, counts


def in_range(column: str, low: int = AGE_RANGE[0], high: int = AGE_RANGE[1]) -> Column:
    """Flag for a plausible value; NULL stays NULL."""
    return F.col(column).between(low, high)


def range_filter(
    df: DataFrame,
    column: str,
    low: int = AGE_RANGE[0],
    high: int = AGE_RANGE[1],
    keep_null: bool = True,
) -> DataFrame:
    """Rows with a value inside the range, and those without a value unless told otherwise."""
    return df.where(F.coalesce(in_range(column, low, high), F.lit(keep_null)))


def handle_nulls(
    df: DataFrame, strategy: str = "drop", columns: Sequence[str] | None = None
) -> DataFrame:
    """``drop`` rows with a NULL, ``fill`` ints with 0 and text with ``UNKNOWN``, or ``keep``.

    Dropping needs the columns that count: over all of them few rows of a feed would stay.
    """
    subset = list(columns) if columns else df.columns
    if strategy == "keep":
        return df
    if strategy == "drop":
        if not columns:
            raise ValueError("name the columns whose NULLs drop a row")
        return df.na.drop(subset=subset)
    if strategy != "fill":
        raise ValueError(f"unknown strategy {strategy!r}")
    fills: Mapping[type, int | str] = {
        T.IntegerType: FILL_INT,
        T.LongType: FILL_INT,
        T.StringType: FILL_TEXT,
    }
    values = {
        f.name: fills[type(f.dataType)]
        for f in df.schema.fields
        if f.name in subset and type(f.dataType) in fills
    }
    return df.na.fill(values) if values else df
