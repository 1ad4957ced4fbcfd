"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write `df` once, compressed by `codec`, and go on from the written table.

    Later steps read just the columns they need, don't repeat the work, and
    survive the loss of executors without going back to the sources.
    """
    path = staged_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, for files of one's own."""
    return f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Remove everything this application has staged; frames over it can't be read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _run_dir(spark: SparkSession) -> str:
    return f"{_shared_dir(spark)}/staged-{spark.sparkContext.applicationId}"


def _shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; in a single local JVM one is made if unset, and removed at exit."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="thalweg-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set(CHECKPOINT_DIR, own)
    return own
