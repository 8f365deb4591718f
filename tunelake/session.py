"""Session set-up and the shared folder in which written intermediate tables live."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def build_session(app_name: str = "tunelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Adaptive execution picks the number of reduce partitions and splits skewed join partitions;
    times are read in UTC; streaming state lives in RocksDB, so it is not bound by executor heap.
    Anything the cluster already sets (executors, memory, ``spark.checkpoint.dir``) is left alone.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one temporary folder per process.
    On a cluster a machine-local folder would lose data with its machine, so that is an error.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tunelake-")
    return _local_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, keeps column pruning for later readers and
    gives the optimizer the true size, so that a small result is broadcast and a large one is not.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    target = os.path.join(tempfile.mkdtemp(prefix="tunelake-"), name)
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
