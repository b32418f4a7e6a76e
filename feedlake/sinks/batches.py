"""Appends that can be repeated: every batch reaches its table once.

A batch is *staged* (written by Spark beside the table), *moved in* (files renamed into the months'
folders under names that carry the batch) and *noted* in the table's ledger. Each step can be
repeated after a stop at any point, and a noted batch is left alone.

    <table>/year=2024/month=1/<batch>-part-....parquet
    <table>.staging/<batch>/           rows on their way; _STAGED lists the files once all are there
    <table>.ledger/<batch>.json        batches that are in, with their rows and files
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.plans.files import Store
from feedlake.sinks.tables import write_partitioned

# Fixed value: names of batches, which become parts of file names.
BATCH = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
STAGED = "_STAGED"


class _Places:
    """Where the parts of one batch lie."""

    def __init__(self, spark: SparkSession, path: str, batch: str):
        if not BATCH.fullmatch(batch):
            raise ValueError(f"{batch!r} is no name for a batch")
        self.table = path.rstrip("/")
        self.store = Store(spark, self.table)
        self.staging = f"{self.table}.staging/{batch}"
        self.staged = f"{self.staging}/{STAGED}"
        self.note = f"{self.table}.ledger/{batch}.json"
        self.batch = batch

    def target(self, name: str) -> str:
        folder, _, file = name.rpartition("/")
        return f"{self.table}/{folder}/{self.batch}-{file}"


def is_noted(spark: SparkSession, path: str, batch: str) -> bool:
    """True once a batch is wholly in its table."""
    at = _Places(spark, path, batch)
    return at.store.exists(at.note)


def stage_batch(df: DataFrame, path: str, batch: str, day: str = "date") -> None:
    """Writes the rows beside the table, by year and month. What a failed try left is replaced."""
    at = _Places(df.sparkSession, path, batch)
    if at.store.exists(at.staged):
        return
    at.store.delete(at.staging)
    write_partitioned(df, at.staging, day)
    files = sorted(at.store.tree(at.staging))
    # Counted from what was written: an observation would be lost with the driver.
    rows = df.sparkSession.read.parquet(at.staging).count() if files else 0
    at.store.write(at.staged, json.dumps({"batch": batch, "rows": rows, "files": files}))


def move_batch(spark: SparkSession, path: str, batch: str, at_most: int | None = None) -> bool:
    """Moves staged files into the table; those already there stay. True if all are in.

    ``at_most`` stops after so many files, as a lost driver would.
    """
    at = _Places(spark, path, batch)
    moved = 0
    for name in json.loads(at.store.read(at.staged))["files"]:
        source, target = f"{at.staging}/{name}", at.target(name)
        if not at.store.exists(source):
            if not at.store.exists(target):
                raise FileNotFoundError(f"{source} is neither staged nor in the table")
            continue
        if moved == at_most:
            return False
        if at.store.exists(target):  # a copying store may stop after the copy
            at.store.delete(target)
        at.store.move(source, target)
        moved += 1
    return True


def note_batch(spark: SparkSession, path: str, batch: str) -> dict:
    """Notes a batch whose files are all in, and clears what is left of its staging."""
    at = _Places(spark, path, batch)
    entry = at.store.read(at.staged)
    at.store.write(at.note, entry)
    at.store.delete(at.staging)
    return json.loads(entry)


def append_batch(df: DataFrame, path: str, batch: str, day: str = "date") -> dict:
    """Appends rows by year and month unless the batch is in already: its rows, and if written.

    After a failure it is called again with the same name, and goes on where it stopped. Rows that
    were staged whole are used as they are, so a second call need not see the same rows as the
    first. One writer at a time may use a name. Readers see the files of a batch as they are moved
    in; :func:`ledger` tells which batches are whole. A batch without rows is noted as such.
    """
    spark = df.sparkSession
    at = _Places(spark, path, batch)
    if at.store.exists(at.note):
        at.store.delete(at.staging)
        return json.loads(at.store.read(at.note)) | {"written": False}
    stage_batch(df, path, batch, day)
    move_batch(spark, path, batch)
    return note_batch(spark, path, batch) | {"written": True}


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The batches that are wholly in a table: batch, rows, files."""
    schema = "batch string, rows bigint, files array<string>"
    folder = f"{path.rstrip('/')}.ledger"
    if not Store(spark, folder).names(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder).select(
        "batch", "rows", F.size("files").alias("files")
    )
