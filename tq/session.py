"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tq") -> SparkSession:
    """Local session with AQE on and the web UI off (for tests, bench and examples)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # call-site capture for error messages costs several Py4J round trips per Column call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    When it is unset, a fresh folder is created only for a local master (tests,
    bench); on a cluster an unset value is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before running this job")
    folder = tempfile.mkdtemp(prefix="tq-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local checkpoint): cuts lineage, survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables next to the checkpoints (shared storage on a cluster)."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)
