"""Runs that become visible whole: written aside first, then published by one record.

``publish_runs`` writes the rows of one or more runs to a folder of their own under ``base/data``.
Records under ``base/_published`` are numbered; each names one such folder, and readers follow the
records only. A record is created whole and only if its number is free, so of two writers one gets the
number and the other looks again: if the first one published a run of its own, it gives up and takes its
folder away. A failure at any earlier moment leaves nothing that a reader sees.

On a local or mounted file system the record is linked into place; elsewhere it is created through
Hadoop's file system without overwriting, which must be atomic there (as on HDFS).
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, place = _files(spark, folder)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole; False if the name is taken."""
    if urlparse(path).scheme in ("", "file"):
        target = urlparse(path).path
        aside = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(aside, "w") as file:
            file.write(text)
        try:
            os.link(aside, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True
    files, place = _files(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _record(spark: SparkSession, path: str) -> str:
    files, place = _files(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _records(spark: SparkSession, base: str) -> dict[int, str]:
    """Folders by the number of their record."""
    numbers = [name for name in _names(spark, f"{base}/_published") if name.isdigit()]
    return {int(n): f"{base}/data/commit={_record(spark, f'{base}/_published/{n}')}" for n in numbers}


def _runs(spark: SparkSession, folder: str) -> set[str]:
    return {name for name in _names(spark, folder) if name.startswith("run=")}


def publish_runs(df: DataFrame, base: str) -> str:
    """Write all runs of ``df`` (column ``run``) and make them visible together; gives their folder.

    Raises ``FileExistsError`` if one of the runs is published already.
    """
    spark, base, own = df.sparkSession, base.rstrip("/"), uuid.uuid4().hex
    folder = f"{base}/data/commit={own}"
    df.write.partitionBy("run").parquet(folder)
    mine, seen = _runs(spark, folder), 0
    while True:
        records = _records(spark, base)
        for number in sorted(n for n in records if n > seen):
            if again := mine & _runs(spark, records[number]):
                files, place = _files(spark, folder)
                files.delete(place, True)
                raise FileExistsError(f"already published: {min(again)}")
            seen = number
        if _create(spark, f"{base}/_published/{seen + 1:012d}", own):
            return folder


def published_runs(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The rows of all published runs; ``schema`` without ``run``, which comes last as a string."""
    base = base.rstrip("/")
    folders = list(_records(spark, base).values())
    whole = StructType([*(f for f in schema.fields if f.name != "run"), StructField("run", StringType())])
    if not folders:
        return spark.createDataFrame([], whole)
    read = spark.read.option("basePath", f"{base}/data").schema(whole.add("commit", StringType()))
    return read.parquet(*folders).drop("commit")
