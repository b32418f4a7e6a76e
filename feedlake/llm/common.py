"""Helpers shared by the operators: code for executors, row keys, Arrow text access."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Tasks carry this package's functions along, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

CHUNK_BYTES = 1 << 16  # text that is turned into arrays at once; a longer text is its own chunk


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bucket_of(doc_id: Column, buckets: int) -> Column:
    """The remainder by which rows are held out; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def text_key(text: Column) -> Column:
    """Stands for a text in narrow tables; rows of equal id and text count as the same document."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.length(text))


def row_key(df: DataFrame) -> Column:
    """Stands for a whole row: rows of equal text and row key are the same in every column."""

    def hashed(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        unordered = "map<" in kind or "variant" in kind
        return F.to_json(F.struct(field.name)) if unordered else F.col(field.name)

    return F.xxhash64(F.lit("row"), *[hashed(field) for field in df.schema.fields])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it new to ``df``."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each, no row split."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def map_rows(df: DataFrame, results: str, function, columns: list[str] | None = None) -> DataFrame:
    """Adds the columns ``results`` (a DDL list) that ``function`` makes from each Arrow batch.

    ``function`` takes an iterator of batches and yields ``(batch, arrays)``. All columns of ``df``
    (or those named) are kept but for such as have the name of a result, which gives way.
    """
    added = T._parse_datatype_string(results)
    names = {field.name.lower() for field in added.fields}
    kept = [c for c in (columns or df.columns) if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)
    target = to_arrow_schema(schema)

    def run(batches):
        for batch, arrays in function(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).cast(target.field(c).type) for c in kept] + list(arrays),
                schema=target,
            )

    return df.mapInArrow(run, schema)
