"""Parquet tables, as a batch or as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The column types of the tables. Stating them saves the pass over
# file footers that schema inference makes, which is long for a table of many files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` stored under ``folder`` as ``name.parquet``.

    A table whose types are not stated above is read with those of its files.
    """
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = 1000
) -> DataFrame:
    """A stream of the table that ``read_table`` reads: of one file, or a folder of files.

    A batch takes ``files_per_trigger`` files at most, so that a backlog is worked off in
    bounded steps.
    """
    # A pattern that only the name itself matches: a file source takes no path of a file.
    return stream_files(spark, f"{folder}/{name}.parque[t]", name, files_per_trigger)


def stream_files(
    spark: SparkSession, path: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of the Parquet files that arrive in ``path`` and hold rows of ``name``."""
    reader = spark.readStream.schema(SCHEMAS[name])
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
