"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant file system). Only when
nothing is configured -- local tests -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Session for tests / bench. Production callers bring their own."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # a join on (k, x) may reuse a partitioning / bucketing on k alone
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 128 * 1024 * 1024,
               max_partitions: int = 100_000) -> dict[str, str]:
    """Session settings sized for a job reading ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at ~``target_partition_bytes`` of input each (never
    fewer than 2 waves of the cluster's cores, never more than
    ``max_partitions``: map-output metadata grows with maps x reducers) and AQE
    coalesces them after measuring; scan splits are the same size; skewed
    shuffle partitions over 4x the median (and 256 MB) are split. Spark spills
    sorts and aggregations beyond memory, so these sizes keep each task's
    working set bounded. E.g. 100 TB on 1000 executors x 8 cores -> 100k
    initial shuffle partitions (~1 GB of input each), coalesced by AQE.
    """
    parts = min(max_partitions,
                max(2 * total_cores, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Reads the cluster's ``spark.checkpoint.dir``. Only a ``local`` master gets a
    folder of its own when that is unset (tests, single-machine runs); elsewhere
    executors would each write to their own disk, so it is an error.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        # getCheckpointDir returns <dir>/<uuid>; the parent is the shared root
        return cur.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory path inside the shared scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return p[len("file:"):] if p.startswith("file:") else p


__all__ = ["get_session", "scale_conf", "scratch_dir", "fresh_path", "cut_lineage", "local_path"]
