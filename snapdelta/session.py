"""Where work folders live.

A cluster names a folder that every executor can reach in ``spark.checkpoint.dir``. Only a
single-machine session (``local[...]``) that names none falls back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from snapdelta.sinks.folders import Folders

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder for work files: the session's ``spark.checkpoint.dir``, or a local one in tests."""
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(
            f"set {CHECKPOINT_DIR} to a folder all executors share; "
            "a machine-local folder would lose files with the machine"
        )
    context.setCheckpointDir(tempfile.mkdtemp(prefix="snapdelta-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, empty folder under the shared root. Spark drops it when the application ends."""
    folder = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    Folders(spark).delete_at_exit(folder)
    return folder
