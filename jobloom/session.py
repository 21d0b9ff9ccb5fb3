"""Session settings and the shared folder for stage tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that the plans rely on. Partition counts are left to the cluster and AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes. The wide text projections make
    # such methods when fused, so Spark is told to split those stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings and send this package to the executors, once per application."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    _send_package(spark)
    return spark


def _send_package(spark: SparkSession) -> None:
    context = spark.sparkContext
    package = Path(__file__).resolve().parent
    name = f"{package.name}.zip"
    if any(Path(file).name == name for file in context.listFiles):
        return
    target = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    context.addPyFile(archive)


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, from ``spark.checkpoint.dir``.

    A private folder is made only for a local master that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="jobloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for stage tables. All of an application's are removed when it ends."""
    context = spark.sparkContext
    own = f"{shared_folder(spark)}/jobloom-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a costly step to the shared folder and go on from the table.

    Later steps may read it several times, and lost executors cost only this step.
    """
    spark = df.sparkSession
    folder = new_run_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rebalance an input of fewer splits than there are cores.

    Text coding is bound by CPU, so a single small file would keep one core busy. Large
    inputs have enough splits and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < cores
    return df.repartition(cores, *keys) if few else df
