"""Publication of a run's tables as a whole.

A run writes into its own folder, `runs/<run id>`; readers follow the file `CURRENT`, which names the published run. Publishing
replaces that one file by an atomic rename, so readers see all layers of one run or of the other, a run that fails in between
leaves the published one as it was, and a repeated run writes its folder anew.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


def run_folder(root: str, run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.:+-]+", run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    return f"{root}/runs/{run_id.replace(':', '-')}"


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def begin(spark: SparkSession, root: str, run_id: str) -> str:
    """The empty folder of a run; what an earlier attempt left there is deleted, unless it is what is published."""
    folder = run_folder(root, run_id)
    if current(spark, root) == folder:
        raise ValueError(f"run {run_id} is published; publish another run instead of changing it")
    path, files = _files(spark, folder)
    files.delete(path, True)
    files.mkdirs(path)
    return folder


def publish(spark: SparkSession, root: str, run_id: str) -> None:
    """Make a finished run the one that readers see."""
    folder = run_folder(root, run_id)
    path, files = _files(spark, folder)
    if not files.exists(path):
        raise ValueError(f"no run {run_id} under {root}")
    jvm = spark.sparkContext._jvm
    staged, target = jvm.org.apache.hadoop.fs.Path(f"{root}/.{POINTER}-{uuid.uuid4().hex}"), jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    out = files.create(staged, True)
    out.write(bytearray(folder.rsplit("/", 1)[1].encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(staged), files.makeQualified(target), how)


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the published run, none before the first."""
    path, files = _files(spark, f"{root}/{POINTER}")
    if not files.exists(path):
        return None
    return f"{root}/runs/{spark.read.text(path.toString()).first()['value']}"


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the published run."""
    folder = current(spark, root)
    if folder is None:
        raise ValueError(f"nothing is published under {root}")
    return spark.read.parquet(f"{folder}/{table}")


def replace_months(df: DataFrame, path: str, column: str = "period") -> None:
    """Write a monthly table partitioned by month; only the months that df holds are replaced. Writing them again changes nothing."""
    dated = df.withColumn("month", F.date_format(column, "yyyy-MM"))
    dated.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
