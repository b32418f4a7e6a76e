"""Raw text feed to typed table (one projection and one filter, no action)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.feeds import Feed
from feedlake.functions import coded, day_of, first_date, lenient_int, tidy


def _day_in(formats: Sequence[str], text: Column) -> Column:
    """The day as it is always read, else by the first notation that fits its date part."""
    date_part = F.split_part(F.split_part(text, F.lit("T"), F.lit(1)), F.lit(" "), F.lit(1))
    return F.coalesce(day_of(text), first_date(date_part, formats))


def typed_feed(
    df: DataFrame,
    feed: Feed,
    country: str,
    ingestion_date: date | None = None,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    """Rename, type and code the columns that exist; every row and unmapped column stays.

    ``date_formats`` are notations of dates that are read besides the usual one.
    """
    named = df.withColumnsRenamed(dict(feed.renames))
    steps = (
        (feed.dates, partial(_day_in, date_formats) if date_formats else day_of),
        (feed.ints, lenient_int),
        (feed.tidied, tidy),
    )
    values = {c: step(F.col(c)) for columns, step in steps for c in columns if c in named.columns}
    for column, codes in feed.codes.items():
        if column in named.columns:
            values[column] = coded(values.get(column, F.col(column)), codes)
    values["country"] = F.lit(country)
    values["ingestion_date"] = F.lit(ingestion_date) if ingestion_date else F.current_date()
    return named.withColumns(values)


def row_is_kept(df: DataFrame, feed: Feed) -> Column:
    """True where any of the feed's deciding columns is present; always true if none exists."""
    deciding = [F.col(c) for c in feed.keep_any if c in df.columns]
    return F.coalesce(*deciding).isNotNull() if deciding else F.lit(True)


def format_feed(
    df: DataFrame,
    feed: Feed,
    country: str,
    ingestion_date: date | None = None,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    """The formatted table of a raw feed."""
    typed = typed_feed(df, feed, country, ingestion_date, date_formats)
    return typed.where(row_is_kept(typed, feed))
