"""SparkSession factory with the settings every plan in this package assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "meteoframe", driver_memory: str | None = None) -> SparkSession:
    """Return (or create) a session: UTC, ANSI on, AQE on, Arrow on, UI off.

    On a cluster the session usually already exists; ``getOrCreate`` then only
    applies the runtime SQL settings below.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if driver_memory:  # only effective when this call starts the JVM (local runs)
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark, required=False)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, required: bool = True) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the setting names a shared folder (HDFS/S3/ABFS) and is left
    alone. Only local test sessions without it get a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            if not required:
                return None
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS, object store) "
                               "that every executor and the driver can reach")
        # Local sessions (tests, one machine) only: a scratch folder is shared by construction.
        current = tempfile.mkdtemp(prefix="meteoframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
