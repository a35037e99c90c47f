"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _folder_of_this_machine(application: str) -> str:
    return tempfile.mkdtemp(prefix="ledgerline-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session without the setting falls back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _folder_of_this_machine(spark.sparkContext.applicationId)
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables this library wrote, on whatever file system they lie."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
