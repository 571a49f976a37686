"""Session defaults and the shared folder for stored intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "shelfwise", **conf: str) -> SparkSession:
    """Session with adaptive execution, skew splitting and UTC dates; extra settings override."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # months are taken from the partition listing; no writer here leaves a partition without rows
        "spark.sql.optimizer.metadataOnly": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent (tests, a laptop) a fresh temporary folder takes its place for the session.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
    return context.getCheckpointDir()


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, label: str = "scratch") -> str:
    """A new folder name below the shared folder; it is removed when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark, path))
    return path


def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has already ended
            return
