"""Delimited text readers. A path may be a file or a directory of part files; all are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedlake.feeds import COMBINED_SCHEMA

# Separators in order of preference when they occur equally often.
SEPARATORS = (",", "\t", ";")


def detect_separator(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The separator that occurs most often in the first line; only that line is fetched."""
    whole_lines = spark.read.option("sep", "\x01").option("quote", "").option("encoding", encoding)
    header = whole_lines.schema("value string").csv(path).first()
    return max(SEPARATORS, key=header.value.count) if header else SEPARATORS[0]


def read_text_csv(
    spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """CSV with a header, every column as text. Names are checked in each part file."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_detected_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV whose separator is found from its header.

    If the likeliest one yields a single column (a quoted header can mislead), the first other
    one that yields more is used. Each try reads the header line only.
    """
    likeliest = detect_separator(spark, path, encoding)
    df = read_text_csv(spark, path, likeliest, encoding)
    if len(df.columns) > 1:
        return df
    others = (read_text_csv(spark, path, s, encoding) for s in (",", ";", "\t") if s != likeliest)
    return next((other for other in others if len(other.columns) > 1), df)


def read_daily_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = COMBINED_SCHEMA,
    infer: bool = False,
) -> DataFrame:
    """A written day table, typed by its known schema or, at the price of a pass, by inference."""
    reader = spark.read.option("header", True)
    return reader.csv(path, inferSchema=True) if infer else reader.schema(schema).csv(path)
