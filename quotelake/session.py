"""Where jobs of a session may write what other tasks read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only in local mode, where the driver is the executor, a temporary folder of
    this machine is made if none is set; on a cluster that is an error, as what
    executors write to their own disks is lost to the others.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has yet."""
    return f"{shared_root(spark)}/quotelake/{name}-{uuid.uuid4().hex}"
