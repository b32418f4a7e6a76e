"""Table writers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.feeds import Feed
from feedlake.functions import fingerprint
from feedlake.sources.snapshots import snapshot_path


# Stands for a line break inside a landed cell: the line separator character.
LINE_BREAK = "\u2028"


def _on_one_line(text: Column) -> Column:
    """Line breaks replaced; the pattern runs only over the rare cell that has one."""
    broken = text.contains("\n") | text.contains("\r")
    return F.when(broken, F.regexp_replace(text, "\r\n|\r|\n", LINE_BREAK)).otherwise(text)


def land_snapshot(
    df: DataFrame, raw_root: str, feed: Feed, day: date | str | None = None, sep: str = ","
) -> str:
    """Writes a raw feed as CSV into its dated directory, blanks kept; returns the path.

    Line breaks inside cells become :data:`LINE_BREAK`, so that every row is one line and files can
    be split.
    """
    path = snapshot_path(raw_root, feed, day or date.today())
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    one_line = df.withColumns({c: _on_one_line(F.col(f"`{c}`")) for c in texts})
    (
        one_line.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet with snappy compression."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str] = ("date", "country")) -> None:
    """Parquet in key order. Sorting belongs to the sink: no earlier step needs the order."""
    write_table(df.orderBy(*keys), path)


def write_csv(
    df: DataFrame, path: str, single_file: bool = False, keys: Sequence[str] = ()
) -> None:
    """CSV with a header, in the order of ``keys``; ``single_file`` is for results of a few rows."""
    out = df.coalesce(1) if single_file else df.orderBy(*keys) if keys else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    day: str = "date",
    mode: str = "overwrite",
    files: int | None = None,
) -> None:
    """Parquet by year and month; overwriting replaces only the months present in ``df``.

    By default the rows are rebalanced by month at run time, which splits a large month over
    several tasks and merges small ones. ``files`` caps the number of tasks instead and suits
    day tables only.
    """
    dated = df.withColumns({"year": F.year(day), "month": F.month(day)})
    spread = dated.coalesce(files) if files else dated.hint("rebalance", "year", "month")
    (
        spread.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One-row metrics as a JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = ("country",),
    values: bool = False,
) -> DataFrame:
    """Row counts of a source and of what was read back from its target, per key.

    Counts of both sides are added up in one aggregation, so a key missing on either side shows.
    With ``values`` a column ``values_equal`` compares fingerprints of all columns of the source,
    which show a changed value where the counts agree; the target's columns are cast to the
    source's types for it. Nothing is sorted or joined for either.
    """
    kinds = {f.name: f.dataType for f in source.schema.fields if values or f.name in keys}
    side = "_reconciled_side"
    as_source = target.select([F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])
    rows = source.select(*[F.col(f"`{c}`") for c in kinds]).withColumn(side, F.lit(0))
    rows = rows.unionByName(as_source.withColumn(side, F.lit(1)))
    own, other = F.col(side) == 0, F.col(side) == 1
    prints = [
        F.struct(*fingerprint(list(kinds), own)).alias("own"),
        F.struct(*fingerprint(list(kinds), other)).alias("other"),
    ]
    sums = rows.groupBy(*keys).agg(
        F.count_if(own).alias("rows_source"),
        F.count_if(other).alias("rows_target"),
        *(prints if values else []),
    )
    told = [(F.col("rows_source") == F.col("rows_target")).alias("ok")]
    if values:
        told.append((F.col("own") == F.col("other")).alias("values_equal"))
    return sums.select(*keys, "rows_source", "rows_target", *told)
