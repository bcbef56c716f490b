"""Session settings the plans are written for. A cluster's own settings win where they are set."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange further down.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A ledger stored by document also meets joins by document and record bucket by bucket.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app_name: str = "tallystone", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in `spark.checkpoint.dir`. A session on one machine without one
    (a test) gets a folder of its own; on several machines that is an error, since they would not see each other's files."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "tallystone-checkpoints")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def _steps_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"


def step_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, on storage that all executors share."""
    return f"{_steps_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step", rows_per_file: int = 0) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from the written copy.

    For results that several later steps read, such as the issue table or the monthly postings: what lies behind
    them runs once, a lost executor does not bring it back, and readers scan only the columns they need. The shuffle files
    behind the table are dropped once it is written. `clear_steps` deletes the tables of an application. rows_per_file: the most rows
    of a file, so that a table written by few tasks is read by many; 0 for no bound."""
    spark = df.sparkSession
    path = step_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_steps(spark: SparkSession) -> None:
    """Delete the tables that `materialize` wrote for this application. Tables read from them are gone with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_steps_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
