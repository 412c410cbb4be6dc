"""Session construction and lineage helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes: UTC wall clock (source timestamps
# carry no zone), adaptive execution for runtime join re-planning and skew
# splitting, and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime size bound for converting a join to a broadcast join
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # let joins on (format, deck_id) use tables bucketed on deck_id alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of TB, ~1000 executors).  Shuffles
# start with many partitions and adaptive execution merges them towards the
# advisory size, so one setting serves small and large inputs; skewed
# partitions above the threshold are split at join time.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
}


MOST_PARTITIONS = 20_000


def cluster_conf(shuffle_bytes: int, target_partition_bytes: int = 1 << 30) -> dict[str, str]:
    """:data:`CLUSTER_CONF` plus a shuffle partition count for a largest shuffle
    of ``shuffle_bytes`` (after column pruning): about one partition per
    ``target_partition_bytes``, at most :data:`MOST_PARTITIONS`, beyond which
    the driver's map-output tracking suffers.  Adaptive execution merges small
    partitions and splits skewed ones."""
    parts = min(MOST_PARTITIONS, max(200, int(shuffle_bytes // target_partition_bytes)))
    conf = dict(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(parts)
    conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(parts)
    return conf


def get_spark(app: str = "deckframe", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # input timestamps carry no zone and are UTC wall clock
    spark.conf.set("spark.sql.session.timeZone", conf["spark.sql.session.timeZone"])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    On a cluster this is whatever the deployment put in ``spark.checkpoint.dir``
    (a shared file system).  Where nothing is configured, as in local tests, it
    is a folder of the warehouse, which a session shares with its executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoint"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root, on its file system."""
    return f"{checkpoint_root(spark)}/deckframe/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, and later reads prune columns and rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
