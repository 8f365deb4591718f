"""File listings as tables: artifacts, and the runs found among their paths."""

from __future__ import annotations

import errno
import os
import re
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.functions.paths import artifact_key, contains_any, relative_key, run_started_at
from tunelake.session import ship_package, written


_LISTED = "path string, is_folder boolean, part int, parts int, length long, modificationTime timestamp"
_LISTED_ARROW = pa.schema(
    {"path": pa.string(), "is_folder": pa.bool_(), "part": pa.int32(), "parts": pa.int32(),
     "length": pa.int64(), "modificationTime": pa.timestamp("us", "UTC")}
)
#: Entries that a task lists of one folder, into how many parts a larger one is dealt, rows of a batch.
LARGE_FOLDER, PARTS, LISTED_ROWS = 20_000, 64, 4096
#: Folders that a task lists.
TASK_FOLDERS = 2048


def local_path(path: str) -> str | None:
    """The name that a ``file:`` path has on the machine; any character may stand in it."""
    found = re.fullmatch("file:(?://(?=/))?(/.*)?", path, re.DOTALL)
    return (found[1] or "/") if found else None


def _entries(folder: str, part: int, parts: int) -> Iterator[tuple]:
    """Name, whether it is a folder, size and time of the entries whose name belongs to the part."""

    def own(name: str) -> bool:
        return parts == 1 or zlib.crc32(name.encode("utf-8", "surrogateescape")) % parts == part

    local = local_path(folder)
    if local is not None:  # one name after the other; only own ones are looked at
        if "%" in local and not os.path.isdir(local):  # a URI with escapes
            local = unquote(local)
        with os.scandir(local) as found:
            for entry in found:
                if own(entry.name):
                    try:
                        is_folder, facts = entry.is_dir(), entry.stat()
                    except OSError as error:  # gone meanwhile, or a link to nothing or to itself
                        if error.errno not in (errno.ENOENT, errno.ELOOP):
                            raise
                        continue
                    time = datetime.fromtimestamp(facts.st_mtime, timezone.utc)
                    yield entry.name, is_folder, 0 if is_folder else facts.st_size, time
        return
    system, inside = fs.FileSystem.from_uri(folder)
    for entry in system.get_file_info(fs.FileSelector(inside)):
        if own(entry.base_name):
            yield entry.base_name, entry.type == fs.FileType.Directory, entry.size or 0, entry.mtime


def _list_folders(
    batches: Iterator[pa.RecordBatch], shown: Callable[[str], bool] | None = None
) -> Iterator[pa.RecordBatch]:
    """The entries of folders, of every name or of those shown; of a large one the parts that are to be listed."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows), _LISTED_ARROW)], schema=_LISTED_ARROW
        )

    ready: list[tuple] = []
    for given in batches:
        for folder, part, parts in zip(*(column.to_pylist() for column in given.columns)):
            rows: list[tuple] = []
            for name, is_folder, length, time in _entries(folder, part, parts):
                if shown is not None and not shown(name):
                    continue
                rows.append((f"{folder.rstrip('/')}/{name}", is_folder, 0, 1, length, time))
                if parts == 1 and len(rows) > LARGE_FOLDER:
                    rows = [(folder, True, i, PARTS, 0, None) for i in range(PARTS)]
                    break
                if parts > 1 and len(rows) >= LISTED_ROWS:
                    yield batch(rows)
                    rows = []
            ready += rows
            if len(ready) >= LISTED_ROWS:
                yield batch(ready)
                ready = []
    if ready:
        yield batch(ready)


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Every file under a folder, at any depth: ``path, length, modificationTime``.

    Names that begin with a dot or an underscore are there too. Folders are listed in the tasks, one
    level after the other, and each level is written once, so no listing is held by the driver. A folder
    with more than ``LARGE_FOLDER`` entries is dealt by its names to ``PARTS`` tasks of the next round,
    each of which looks at its own share only and passes on a bounded batch at a time. For a store that
    keeps an inventory of its objects, that table serves as listing itself.
    """
    start = root if re.match("[A-Za-z][A-Za-z0-9+.-]*:", root) else "file:" + os.path.abspath(root)
    return list_folders(spark, [start])


def list_folders(spark: SparkSession, starts: list[str], shown: Callable[[str], bool] | None = None) -> DataFrame:
    """Every file under several folders, as ``list_artifacts``; with ``shown`` only what lies under names of that kind."""
    ship_package(spark)
    folders = spark.createDataFrame([(start.rstrip("/"), 0, 1) for start in starts], "path string, part int, parts int")
    files = None
    while True:
        of_one = F.col("parts") == 1
        small, large = folders.agg(F.count_if(of_one), F.count_if(~of_one)).first()
        if files is not None and not small + large:
            return files
        tasks = large + max(min(small, spark.sparkContext.defaultParallelism), -(-small // TASK_FOLDERS))
        dealt = folders.repartition(tasks, "path", "part")
        listed = written(dealt.mapInArrow(lambda batches: _list_folders(batches, shown), _LISTED), "listing")
        here = listed.filter(~F.col("is_folder")).drop("is_folder", "part", "parts")
        files = here if files is None else files.unionByName(here)
        folders = listed.filter("is_folder").select("path", "part", "parts")


def exclude_paths(artifacts: DataFrame, patterns: list[str], path: str = "path") -> DataFrame:
    """Drop a path that holds any pattern as a substring."""
    return artifacts.filter(~contains_any(F.col(path), patterns))


def artifact_manifest(
    artifacts: DataFrame, root: str, prefix: str, exclude: list[str] = (), path: str = "path"
) -> DataFrame:
    """The upload list of a folder: each kept file with its object ``key``."""
    kept = exclude_paths(artifacts, list(exclude), path)
    return kept.withColumn("relative", relative_key(F.col(path), root)).filter(
        F.col("relative").isNotNull() & (F.col("relative") != "")
    ).withColumn("key", artifact_key(prefix, F.col("relative")))


def relative_keys(artifacts: DataFrame, prefix: str, key: str = "path") -> DataFrame:
    """Keys below a prefix with the part that follows it; the prefix itself is dropped."""
    return artifacts.withColumn("relative", relative_key(F.col(key), prefix)).filter(
        F.col("relative").isNotNull() & (F.col("relative") != "")
    )


def with_run(artifacts: DataFrame, base: str, path: str = "path") -> DataFrame:
    """Add ``run`` (the folder directly under ``base``) and ``inside`` (the path within it)."""
    rel = F.col("_rel")
    return (
        artifacts.withColumn("_rel", relative_key(F.col(path), base.rstrip("/") + "/"))
        .filter(F.contains(rel, F.lit("/")))
        .withColumn("run", F.substring_index(rel, "/", 1))
        .withColumn("inside", F.substr(rel, F.length("run") + 2))
        .drop("_rel")
    )


def list_runs(artifacts: DataFrame, base: str, path: str = "path") -> DataFrame:
    """Timestamped folders directly under ``base``: ``run, started_at, prefix, logs_prefix, formatted_date``.

    Folders whose name is not a time are passed over.
    """
    base = base.rstrip("/")
    names = with_run(artifacts, base, path).select("run").distinct()
    return (
        names.withColumn("started_at", run_started_at(F.col("run")))
        .filter(F.col("started_at").isNotNull())
        .withColumn("prefix", F.concat(F.lit(base + "/"), F.col("run")))
        .withColumn("logs_prefix", F.concat(F.col("prefix"), F.lit("/logs/")))
        .withColumn("formatted_date", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss"))
    )
