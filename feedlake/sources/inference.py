"""Types of text columns, found in one aggregation over one scan.

Types form a lattice: a whole number of 32 bits is one of 64 bits, which is a real number, and every
value is text. A cell gives the set of types that can hold it, as bits; a column's type is the first
of those that all its cells share. Sets are merged by a bitwise and, so tasks send one number a
column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources.delimited import read_detected_csv

# Types in the order of preference, each a bit of a set.
TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean", "string")
_INT, _BIGINT, _DOUBLE, _DATE, _TIMESTAMP, _BOOLEAN, _STRING = (1 << k for k in range(len(TYPES)))
_ALL = (1 << len(TYPES)) - 1
# Shapes of cells. Each is tested before a cast, as a failed cast is dear.
WHOLE = r"^[+-]?\d{1,19}$"
REAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"
SPECIAL = r"^([+-]?Infinity|NaN)$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
MOMENT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"
TRUTH = r"^(?i)(true|false)$"


def _holders(cell: Column) -> Column:
    """The types that can hold a cell; all of them for an empty one."""
    whole, day = cell.rlike(WHOLE), cell.rlike(DAY)
    return (
        F.when(cell.isNull(), _ALL)
        .when(whole & cell.try_cast("int").isNotNull(), _INT | _BIGINT | _DOUBLE | _STRING)
        .when(whole & cell.try_cast("bigint").isNotNull(), _BIGINT | _DOUBLE | _STRING)
        .when(cell.rlike(REAL) | cell.rlike(SPECIAL), _DOUBLE | _STRING)
        .when(day & cell.try_cast("date").isNotNull(), _DATE | _TIMESTAMP | _STRING)
        .when(cell.rlike(MOMENT) & cell.try_cast("timestamp").isNotNull(), _TIMESTAMP | _STRING)
        .when(cell.rlike(TRUTH), _BOOLEAN | _STRING)
        .otherwise(_STRING)
    )


def infer_types(texts: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: column, type, present (cells that are not empty).

    A column without any value is text. The scan of ``texts`` is read once, and what the tasks send
    is two numbers per column.
    """
    names = list(columns or texts.columns)
    merged = texts.agg(
        *[F.bit_and(_holders(F.col(f"`{c}`"))).alias(f"t{k}") for k, c in enumerate(names)],
        *[F.count(f"`{c}`").alias(f"n{k}") for k, c in enumerate(names)],
    )

    def name_of(held: Column, present: Column) -> Column:
        chosen = F.when(present == 0, "string")
        for k, kind in enumerate(TYPES):
            chosen = chosen.when(held.bitwiseAND(1 << k) != 0, kind)
        return chosen

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            name_of(F.col(f"t{k}"), F.col(f"n{k}")).alias("type"),
            F.col(f"n{k}").alias("present"),
        )
        for k, c in enumerate(names)
    ]
    return merged.select(F.inline(F.array(*rows)))


def read_inferred_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8"
) -> DataFrame:
    """CSV typed by :func:`infer_types`; the casts are part of the scan that follows."""
    texts = read_detected_csv(spark, path, encoding)
    kinds = {row["column"]: row["type"] for row in infer_types(texts).collect()}
    return texts.select([F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in texts.columns])
