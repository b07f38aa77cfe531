"""Reading the tables, telling rows apart, and cutting lineage in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The column types of the tables.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def extended(df: DataFrame, more: str, without: tuple[str, ...] = ()) -> StructType:
    """The schema of ``df`` less some columns, with the columns ``more`` after them."""
    fields = [f for f in df.schema.fields if f.name not in without]
    return StructType(fields + StructType.fromDDL(more).fields)


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row in ``__row``.

    Ids may be null or repeated, so the operators tell rows apart by this number. It
    depends on how the input is dealt to tasks, which may change from one job to the next
    as executors come and go: write the numbered rows before they are read twice, or take
    ``rows_written``. A column ``__row`` that is there is kept.
    """
    if "__row" in docs.columns:
        return docs
    return docs.withColumn("__row", F.monotonically_increasing_id())


def rows_written(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, as a table: every job reads the same number for a row."""
    return docs if "__row" in docs.columns else cut(with_row(docs), "zstd")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a new temporary folder; elsewhere that is
    an error, as executors could not read each other's files.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tallyspan-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again, so that no step runs twice.

    The files outlive a lost executor. They stay until the run's folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """``df``, to be broadcast if it has ``most_rows`` rows or fewer.

    For a written table of narrow rows, such as row numbers, that meets a wide one: the
    wide one then stays where it is. A longer table is joined as any other.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``: joins on it move only the other side.

    There are as many buckets, of one file each, as ``spark.sql.shuffle.partitions``. The
    table has a name of its own in the session's catalog and stays as ``cut``'s files do.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tallyspan_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).option(
        "path", f"{shared_folder(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    return spark.table(name)
