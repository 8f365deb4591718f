"""A streaming source for text files that grow: ``tail``.

Spark's own text source takes a file once; lines that are appended later never arrive. The offset of this
source is a table of the files of a folder and how far their whole lines reach. What lies between two such
tables is read by tasks, ``CHUNK_BYTES`` each. Spark logs the tables with the micro-batches, so every line
arrives once, also after a restart.

A file is known by its first bytes, not by its name. A log that was moved aside is read on under its new
name, and the new file under the old name from its beginning; so is a file that was cut off and written
anew with other first bytes, or fewer bytes than were read. Of files that begin alike the one that kept its
name goes on. A line arrives when its end is there; what stands after the last line break waits. Packed files
(``.gz``) are left out, as what they hold has been followed before.

The table has one row for each file of the folder and passes through the driver at each trigger, which
looks at the first bytes of each file, and for the last line break of those that have grown.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tunelake.session import ship_package

CHUNK_BYTES = 16 << 20
#: Bytes by which a file is known, and bytes that are looked at at a time for a line break.
HEAD_BYTES, STEP_BYTES = 256, 1 << 16

SCHEMA = "path string, start long, value string"

#: By name: the first bytes of a file (base64), where its last whole line ends.
State = dict[str, dict]


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", folder))


def _files(folder: str) -> Iterator[tuple[fs.FileSystem, fs.FileInfo]]:
    system, inside = _open(folder)
    for entry in system.get_file_info(fs.FileSelector(inside, allow_not_found=True)):
        if entry.type == fs.FileType.File and not entry.base_name.startswith((".", "_")):
            if not entry.base_name.endswith(".gz"):
                yield system, entry


def _head(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_file(path) as source:
        return source.read(HEAD_BYTES)


def last_break(source, high: int) -> int:
    """The place after the last line break before ``high``; 0 if there is none."""
    while high > 0:
        low = max(0, high - STEP_BYTES)
        source.seek(low)
        at = source.read(high - low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        high = low
    return 0


def whole_lines(folder: str, known: dict[tuple[str, int], int]) -> State:
    """How far the whole lines of each file reach; ``known`` remembers it by name and size."""
    state = {}
    for system, entry in sorted(_files(folder), key=lambda f: f[1].base_name):
        head, place = _head(system, entry.path), (entry.base_name, entry.size)
        if place not in known:
            with system.open_input_file(entry.path) as source:
                known[place] = last_break(source, entry.size)
        end = known[place]
        state[entry.base_name] = {"head": base64.b64encode(head[:end]).decode(), "end": end}
    return state


def ranges(before: State, after: State) -> Iterator[tuple[str, int, int, bytes]]:
    """Name, start, end and first bytes of what is in ``after`` and not in ``before``."""

    def bytes_of(state: dict) -> bytes:
        return base64.b64decode(state["head"])

    left = {name: (bytes_of(state), state["end"]) for name, state in before.items() if state["end"]}
    origin = {}
    for same_name in (True, False):
        for name, state in after.items():
            if name not in origin:
                fits = [
                    n for n, (head, end) in left.items()
                    if (n == name) == same_name and state["end"] >= end and bytes_of(state).startswith(head)
                ]
                if fits:
                    origin[name] = left.pop(max(fits, key=lambda n: len(left[n][0])))[1]
    for name, state in after.items():
        if state["end"] > (start := origin.get(name, 0)):
            yield name, start, state["end"], bytes_of(state)


def lines_between(source, start: int, low: int, high: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Of the whole lines in ``[start, end)`` those that begin in ``[low, high)``, with their places."""
    at = low
    if low > start:  # a line that runs into this range belongs to the one before
        at = low - 1
        source.seek(at)
        while at < high:
            part = source.read(STEP_BYTES)
            found = part.find(b"\n")
            at += len(part) if found < 0 else found + 1
            if found >= 0 or not part:
                break
    source.seek(at)
    read, rest = at, b""
    while at < high and read < end:
        part = source.read(min(STEP_BYTES, end - read))
        if not part:
            return
        read += len(part)
        *lines, rest = (rest + part).split(b"\n")
        for line in lines:
            if at >= high:
                return
            yield at, line
            at += len(line) + 1


class _Range(InputPartition):
    def __init__(self, name: str, head: bytes, start: int, low: int, high: int, end: int) -> None:
        self.name, self.head = name, head
        self.bounds = (start, low, high, end)


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder
        self._known: dict[tuple[str, int], int] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": whole_lines(self.folder, self._known)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [
            _Range(name, head, low, at, min(at + CHUNK_BYTES, high), high)
            for name, low, high, head in ranges(start["files"], end["files"])
            for at in range(low, high, CHUNK_BYTES)
        ]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        # A batch that runs again may find the file under another name.
        own = sorted(_files(self.folder), key=lambda f: f[1].base_name != partition.name)
        for system, entry in own:
            if entry.size >= partition.bounds[3] and _head(system, entry.path).startswith(partition.head):
                break
        else:
            raise FileNotFoundError(f"{self.folder}: {partition.name} is gone before it was read")
        with system.open_input_file(entry.path) as source:
            rows: list[tuple[int, str]] = []
            size = 0
            for at, line in lines_between(source, *partition.bounds):
                rows.append((at, line.removesuffix(b"\r").decode("utf-8", "replace")))
                size += len(line)
                if size > STEP_BYTES:
                    yield self._batch(partition.name, rows)
                    rows, size = [], 0
            if rows:
                yield self._batch(partition.name, rows)

    @staticmethod
    def _batch(name: str, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        places, values = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(rows)), pa.array(places, pa.int64()), pa.array(values, pa.string())],
            names=["path", "start", "value"],
        )


class TailSource(DataSource):
    """``spark.readStream.format("tail").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"])


def tail_log(spark: SparkSession, folder: str) -> DataFrame:
    """The whole lines of the text files of a folder as they are written: file, place in it, ``value``.

    Files may grow between triggers, be moved aside inside the folder, or be cut off.
    """
    ship_package(spark)
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail").load(folder)
