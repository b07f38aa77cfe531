"""Session settings the jobs in this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a cluster alike.
COMMON_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot partition of a sort-merge join while the job runs.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits hot partitions of the rebalance step ahead of a table write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State larger than executor memory lives in RocksDB, snapshotted to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Merges session windows in the map task, so a hot user shuffles sessions, not rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    app: str = "tallyspan",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the common settings.

    Leave ``master`` unset under spark-submit. On a cluster set
    ``shuffle_partitions`` near (bytes shuffled / 200 MB): adaptive execution
    joins small partitions but splits big ones only in joins and rebalances.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    conf = dict(COMMON_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
