"""Session helpers.

The library never creates a global session; callers pass one in. These helpers
exist for tests, the bench and the command-line pipeline.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library assumes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from the planner's file-size estimate (compressed parquet sizes
    # understate memory size; that rule broadcast a fact table). Broadcasts come only
    # from `joins.sized_broadcast` (a counted bound) or from AQE, which converts a
    # join after measuring the actual shuffle output of a side.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Remove checkpoint files of datasets no longer referenced (shared folder hygiene).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerspark",
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (`spark.checkpoint.dir`, set by the cluster); only when
    it is unset — local runs and tests — fall back to a fresh scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def write_back(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` and survives a lost executor, but the
    plan is computed once (an eager checkpoint computes it twice: once to count,
    once to write the checkpoint files); readers get a columnar table with
    pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def cluster_conf(largest_shuffle_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 ** 2,
                 scan_split_bytes: int = 512 * 1024 ** 2) -> dict[str, str]:
    """Partition sizing for a cluster session, to add to ``BASE_CONF``.

    ``spark.sql.shuffle.partitions`` is the initial reducer count: enough that
    the largest shuffle (at ledger scale the entry_id grouping and the
    lineitem-orders join) gives about ``partition_bytes`` per reducer, and at
    least three waves over the cores. AQE then coalesces small reducers to the
    advisory size and splits skewed ones, so marts (thousands of rows) do not
    run thousands of empty tasks. Scan splits of ``scan_split_bytes`` keep the
    scan task count of a 100 TB input near 200k.
    """
    n = max(3 * total_cores, math.ceil(largest_shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    }
