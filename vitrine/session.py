"""Session settings for local use, and the few settings the operators read."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benches. On a cluster, use the cluster's own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vitrine")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("vitrine.demonstration.splits", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share, named by `spark.checkpoint.dir`. A local session that names none
    (a test, a trial) gets a temporary one; on a cluster that is an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    folder = folder or tempfile.mkdtemp(prefix="vitrine-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
