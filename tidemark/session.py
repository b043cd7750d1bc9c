"""Session builder and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on; shuffle width is left to it unless given."""
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(options or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session may go without one; it then gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A path no other run uses, below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there, whose rows nobody will read again."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path)


def publish_folder(spark: SparkSession, staged: str, folder: str) -> None:
    """Give a folder that is written in full its name, so that nobody ever reads a part of it."""
    context = spark.sparkContext
    path, target = (context._jvm.org.apache.hadoop.fs.Path(f) for f in (staged, folder))
    if not path.getFileSystem(context._jsc.hadoopConfiguration()).rename(path, target):
        raise OSError(f"{staged} cannot become {folder}")


def let_workers_import(spark: SparkSession) -> None:
    """Python workers on this machine find the package wherever the driver found it.

    On a cluster it is installed or shipped with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, *paths) if p)
