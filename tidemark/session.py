"""Session settings that decide results, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on. Sizes (executors, memory, shuffle partitions,
# split size) belong to the cluster and are left to the submitter.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Run-time re-planning: coalescing small shuffle partitions, splitting skewed join
# partitions, and switching to a broadcast once the measured size allows it.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above, overridden or extended by ``settings``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RESULT_SETTINGS, **ADAPTIVE_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Where neither that setting nor a checkpoint folder is there, a local session, whose
    executors are the driver, gets a temporary one; any other master is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that all executors share: "
                f"intermediate tables of a session on {context.master} need one"
            )
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one job's tables inside the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path, wherever it is stored."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.delete(place, True)
