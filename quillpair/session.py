"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Caller's option: tasks to deal a text table out to. Unset: the scan's own splits.
SCAN_PARTITIONS_CONF = "spark.quillpair.scanPartitions"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quillpair",
                  scan_partitions: int | None = None, shared_dir: str | None = None) -> SparkSession:
    """Session for tests and the local bench. On a cluster use the cluster's session.

    ``scan_partitions`` deals text tables out to that many tasks (see
    ``sources.tables``); ``shared_dir`` is the folder for intermediate tables.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Text rows are CPU-heavy per byte: the default 1 MB floor would fold a
        # small local shuffle into one or two tasks before the text work.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(SCAN_PARTITIONS_CONF, str(scan_partitions or ""))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if shared_dir:
        spark.sparkContext.setCheckpointDir(shared_dir)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by driver and executors.

    The cluster names it in ``spark.checkpoint.dir``. Where it is unset, a
    local master (one machine, so any folder is shared) gets a scratch
    folder; on a cluster that is an error, since executors could not read a
    folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="quillpair-shared-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Computed once, its lineage is cut, it survives lost executors, and the
    planner knows its size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
