"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on; all can be changed at run time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_LOCAL_FOLDERS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the jobs rely on to a session made elsewhere."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cardwarden")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: there the
    driver and the executors are the same process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="cardwarden-")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; the job's user owns its clean-up."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
