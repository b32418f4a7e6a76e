"""Intermediate tables in the cluster's shared folder.

A table written there can be read again after any executor is lost, and its size is known to the
planner. Nothing is kept in executor memory or on a local disk. The library never chooses the
folder: ``spark.checkpoint.dir`` names it, under any master. Only an entry point may set it.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; an error if it is unset."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/feedlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under this application's id."""
    return f"{_own_folder(spark)}/{name}-{uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes one settled table that nothing reads any more."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Deletes what this application settled, once nothing reads it any more."""
    delete_path(spark, _own_folder(spark))


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes a table that several later steps read, and reads it back.

    Worth it where the table is small against its inputs, as a day table is against its feed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._settled_at = path  # for discard
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes settled tables, given as :func:`settle` returned them.

    Only where every result made from them has been written itself, so that nothing lost could ask
    for them again.
    """
    for table in tables:
        delete_path(table.sparkSession, table._settled_at)
