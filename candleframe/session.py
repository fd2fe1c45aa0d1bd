"""Session helpers for tests, the bench and scripts (a cluster brings its own session)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candleframe") -> SparkSession:
    """A local session with AQE on, UI off, UTC session zone and a checkpoint dir."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("CANDLEFRAME_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without that setting gets a temporary
    folder; on a cluster a missing setting is an error, never a machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="candleframe-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialize a small derived table once in the checkpoint folder (eager; cuts lineage).

    Branches that read the result do not recompute it, and a lost executor does not lose
    it: the files live in the shared ``spark.checkpoint.dir``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checked_broadcast(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """A small stored table, marked for broadcast if it has at most ``most_rows`` rows.

    Beyond that it is joined by shuffle, where AQE splits skewed partitions.
    """
    few = df.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(df) if few else df
