"""Writing tables, and the shared folder that job files go to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Without the setting this is an error: executors elsewhere could not read what one
    machine holds, and a session's settings are not this package's to change.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of a job, inside the shared folder.

    A job that is to go on where it stopped needs the same folder again: keep the name,
    or name one yourself. Nothing here deletes a run's folder.
    """
    return f"{shared_folder(spark)}/tallyspan/{name}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that all uses see the same rows."""
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    rows_per_file: int = 10_000_000,
    mode: str = "errorifexists",
) -> None:
    """Write Parquet with files of even size, whatever the spread of the partitions.

    The rebalance step brings the rows of one partition value together, so a task
    does not open a file per value, and adaptive execution splits the values that
    hold too much for one task. ``sort_by`` orders rows inside each file, which
    makes the min/max statistics of those columns worth reading.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
