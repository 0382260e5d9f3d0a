"""Where intermediate files go."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder of this machine; anywhere else
    a missing setting is an error, since a local folder would not be seen by other machines.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="rowsieve-")


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path below :func:`shared_dir` that nobody else uses."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
