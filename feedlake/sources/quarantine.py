"""Delimited text whose broken rows are set aside instead of being bent into shape.

The plain reader pads a short row with NULL, drops the surplus cells of a long one, and lets a quote
that is never closed swallow separators. Here each line is looked at before it is parsed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sources.delimited import SEPARATORS, read_detected_csv

# Why a line is set aside.
UNCLOSED = "unclosed quote"
SURPLUS = "surplus cells"
MISSING = "missing cells"


@dataclass(frozen=True)
class CheckedCsv:
    """Both parts of a scan: ``rows`` as text columns, ``rejects`` as file, line and reason."""

    rows: DataFrame
    rejects: DataFrame
    lines: DataFrame
    """All data lines with their reason, NULL for a sound one."""


def _reason(line: Column, sep: str, columns: int) -> Column:
    """Why a line has not the right cells; NULL if it has.

    Lines without a quote, nearly all of a feed, take a comparison of lengths only.
    """
    mark = re.escape(sep)
    # Inner quotes go first, then whole quoted cells; a quote that still opens a cell has no end.
    inner = F.regexp_replace(line, r'\\"|""', "")
    outside = F.regexp_replace(inner, f'(^|{mark})"[^"]*"', "$1")
    quoted = line.contains('"')
    bare = F.when(quoted, outside).otherwise(line)
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    return (
        F.when(quoted & bare.rlike(f'(^|{mark})"'), UNCLOSED)
        .when(cells > columns, SURPLUS)
        .when(cells < columns, MISSING)
    )


def _header(spark: SparkSession, path: str, encoding: str) -> str:
    whole = spark.read.option("sep", "\x01").option("quote", "").option("encoding", encoding)
    first = whole.schema("value string").csv(path).first()
    return first.value if first else ""


def read_checked_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> CheckedCsv:
    """CSV with a header, its separator found as by the plain reader, broken lines set aside.

    Every data line is in exactly one of the two parts. The header is checked in each part file.
    Blank lines are no rows. A quote counts where it opens a cell, as for the plain reader.
    """
    names = read_detected_csv(spark, path, encoding).columns
    header = _header(spark, path, encoding)
    sep = next((s for s in _by_count(header) if _cells(header, s) == len(names)), SEPARATORS[0])
    # A line is one cell under a separator that no line has; its column is named like the header,
    # so that the reader itself skips the header of each part file and checks it.
    schema = T.StructType([T.StructField(header, T.StringType())])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", "\x01")
        .option("quote", "")
        .option("encoding", encoding)
        .csv(path)
        .select(F.col("_metadata.file_name").alias("file"), F.col(f"`{header}`").alias("line"))
        .withColumn("reason", _reason(F.col("line"), sep, len(names)))
    )
    places = [f"c{k}" for k in range(len(names))]
    cells = F.from_csv("line", ", ".join(f"{c} string" for c in places), {"sep": sep})
    parsed = lines.where("reason is null").select(cells.alias("cells")).select("cells.*")
    return CheckedCsv(parsed.toDF(*names), lines.where("reason is not null"), lines)


def _by_count(header: str) -> list[str]:
    return sorted(SEPARATORS, key=header.count, reverse=True)


def _cells(header: str, sep: str) -> int:
    outside = re.sub(rf'(^|{re.escape(sep)})"[^"]*"', r"\1", re.sub(r'\\"|""', "", header))
    return outside.count(sep) + 1
