"""Index documents: one JSON document per row, and files in bulk-request form.

Sending the files to a search service is left to its own client.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import real_or_null, whole_or_null

# Document fields with their index types.
INDEX_FIELDS = {
    "date": "date",
    "country": "keyword",
    "total_cases": "integer",
    "total_hospitalizations": "integer",
    "total_icu": "integer",
    "total_deaths": "integer",
    "total_recovered": "integer",
    "active_cases": "integer",
    "regions_count": "integer",
    "avg_age": "float",
    "mortality_rate": "float",
    "recovery_rate": "float",
    "processed_at": "date",
}
ZERO_INDEX_FIELDS = {
    "date": "date",
    "country": "keyword",
    "total_cases": "float",
    "total_hospitalizations": "float",
    "total_icu": "float",
    "total_deaths": "float",
    "total_recovered": "float",
    "regions_count": "integer",
    "avg_age": "float",
}
BULK_FILE = 100_000  # documents of a bulk file; a sender cuts its own requests from it
COERCIONS = {"integer": whole_or_null, "float": real_or_null}
# What an index accepts of each type: 32-bit integers, single-precision numbers, the
# years of its dates, and keywords by their bytes.
INTEGERS = (-(1 << 31), (1 << 31) - 1)
FLOAT_SIZE = 3.4028234663852886e38
YEARS = (0, 9999)
KEYWORD_BYTES = 32766


def index_mapping(fields: Mapping[str, str] = INDEX_FIELDS) -> dict:
    """The mapping an index for these documents is created with."""
    return {
        "mappings": {"properties": {name: {"type": kind} for name, kind in fields.items()}},
        "settings": {"number_of_shards": 1, "number_of_replicas": 0},
    }


def to_documents(
    combined: DataFrame,
    missing: str = "null",
    fields: Mapping[str, str] = INDEX_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows as JSON text in ``document``, with the ``keep`` columns beside it.

    Values are coerced to their field's type. What is missing or cannot be coerced is an explicit
    null, or 0 with ``missing="zero"``.
    """
    if missing not in ("null", "zero"):
        raise ValueError(f"unknown missing {missing!r}")

    def cell(name: str, kind: str):
        coerce = COERCIONS.get(kind)
        value = coerce(F.col(name)) if coerce else F.col(name)
        if missing == "zero" and coerce:
            value = F.coalesce(value, F.lit(0))
        return value.alias(name)

    cells = [cell(name, kind) for name, kind in fields.items() if name in combined.columns]
    document = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
    return combined.select(*keep, document.alias("document"))


def _problem(name: str, kind: str, coerced: Column, value: Column) -> Column:
    """What an index would refuse of a value, NULL where nothing is wrong or nothing is there."""
    if kind == "integer":
        # Coerced to 64 bits; the number itself shows when it does not even fit those.
        number = real_or_null(value)
        wrong = ~number.between(*INTEGERS) | ~coerced.between(*INTEGERS)
        return F.when(wrong, f"{name} is no 32-bit integer")
    if kind == "float":
        return F.when(F.abs(coerced) > FLOAT_SIZE, f"{name} is no single-precision number")
    if kind == "date":
        return F.when(~F.year(value.try_cast("date")).between(*YEARS), f"{name} is no date").when(
            value.isNotNull() & value.try_cast("date").isNull(), f"{name} is no date"
        )
    if kind == "keyword":
        return F.when(
            F.octet_length(value.cast("string")) > KEYWORD_BYTES, f"{name} is too long a keyword"
        )
    raise ValueError(f"unknown index type {kind!r}")


def checked_documents(
    combined: DataFrame,
    missing: str = "null",
    fields: Mapping[str, str] = INDEX_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """As :func:`to_documents`, with what an index would refuse of each row in ``problems``.

    Every value is held against the type its field is declared with. What is missing, or is no
    number at all and so becomes null, is no problem; a number beyond the type's bounds is.
    """
    present = {name: kind for name, kind in fields.items() if name in combined.columns}
    problems = [
        _problem(name, kind, COERCIONS[kind](F.col(name)) if kind in COERCIONS else F.col(name),
                 F.col(name))
        for name, kind in present.items()
    ]
    marked = combined.withColumn("problems", F.array_compact(F.array(*problems)))
    kept = [c for c in keep if c != "problems"]
    return to_documents(marked, missing, fields, [*kept, "problems"])


def bulk_lines(documents: DataFrame, index: str) -> DataFrame:
    """Action and source line of each document as one value, so that no writer can part them."""
    action = json.dumps({"index": {"_index": index}}, separators=(",", ":"))
    return documents.select(F.concat_ws("\n", F.lit(action), "document").alias("value"))


def write_bulk(
    documents: DataFrame,
    path: str,
    index: str,
    batch: int = BULK_FILE,
    fields: Mapping[str, str] = INDEX_FIELDS,
) -> None:
    """Replaces the target with its mapping and with bulk files of at most ``batch`` documents."""
    spark = documents.sparkSession
    one_row = spark.range(0, 1, 1, numPartitions=1)
    mapping = one_row.select(F.lit(json.dumps(index_mapping(fields))).alias("value"))
    mapping.write.mode("overwrite").text(f"{path}/mapping")
    (
        bulk_lines(documents, index)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", batch)
        .text(f"{path}/bulk")
    )


def write_checked_bulk(
    documents: DataFrame,
    path: str,
    index: str,
    batch: int = BULK_FILE,
    fields: Mapping[str, str] = INDEX_FIELDS,
) -> dict:
    """Bulk files of the sound documents, a file of the rejected ones, and the counts of both.

    ``documents`` are as :func:`checked_documents` gives them. Rejects lie under ``rejected`` as
    JSON with their problems. What was written is counted by reading it back and held against the
    documents given; an error if the counts do not add up.
    """
    spark = documents.sparkSession
    sound = documents.where(F.size("problems") == 0)
    write_bulk(sound, path, index, batch, fields)
    rejected = documents.where(F.size("problems") > 0).select("document", "problems")
    rejected.write.mode("overwrite").json(f"{path}/rejected")
    counts = {
        "given": documents.count(),
        # Each document takes an action line and a source line.
        "written": spark.read.text(f"{path}/bulk").count() // 2,
        "rejected": spark.read.text(f"{path}/rejected").count(),
    }
    if counts["given"] != counts["written"] + counts["rejected"]:
        raise RuntimeError(f"documents are lost: {counts}")
    return counts


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected documents with their problems."""
    return spark.read.schema("document string, problems array<string>").json(f"{path}/rejected")
