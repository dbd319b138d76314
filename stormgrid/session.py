"""Session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the plans in this package count on. Sizes and parallelism stay with the cluster:
# set spark.sql.shuffle.partitions well above the core count there, AQE merges what is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a value that does not fit its declared type is an error, never a silent null
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # call-site capture doubles the driver's round trips while a plan is put together
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "stormgrid", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_ansi(spark: SparkSession) -> None:
    """Refuse to load where casts would turn values that do not fit into nulls."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true: values that do not fit must raise")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints and intermediate tables.

    Only a local session without one gets a folder of its own; on a cluster a folder that
    other machines cannot see would lose data with the first executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="stormgrid-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new path for one intermediate table."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/stormgrid/{app}/{label}-{uuid.uuid4().hex[:12]}"
