"""Session helpers.

``local_session`` is for tests and the bench only; on a cluster the session
comes from ``spark-submit`` and the functions here only read its settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. Time zone: readings carry
# zone-less local times; the streaming path casts them to TIMESTAMP and the
# year/month/day partition columns must not move across a zone boundary.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "roadpulse", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ROADPULSE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; a cluster session without it is refused. Only a local-mode session
    without it (tests) gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared "
                               "folder (executors and the driver write lineage cuts and job outputs there)")
        configured = tempfile.mkdtemp(prefix="roadpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local_master(master: str | None) -> bool:
    """True for a single-machine master (``local``, ``local[8]``,
    ``local-cluster[2,1,1024]``), where a machine-local folder is shared by
    every executor."""
    return bool(master) and (master == "local" or master.startswith(("local[", "local-cluster[")))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for intermediate
    job outputs (stream sources/sinks, stream checkpoints, round trips) that
    must survive executor loss."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
