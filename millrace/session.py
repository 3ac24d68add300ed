"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on, for as long as the session lives: frames run after this returns. Partition counts stay
    with the cluster's own settings. Rows go to Python workers in batches of a few MB, not of 64."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is set, a temporary one in a single process only: elsewhere it is an error,
    as executors would each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
