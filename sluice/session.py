"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime SQL settings. All times are naive UTC, so the session zone is pinned. A join must place both
#: sides by all of its keys: matching a small side that is placed by station alone would pull a hot
#: station's rows into one task.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "sluice") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture on every column expression dominates the time to build wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``. Only a session whose executors run in the driver's
    own process may leave it unset; it gets a fresh local folder."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sluice-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df):
    """Write ``df`` to the shared folder and go on from there, so that loops do not grow the plan."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
