"""One ordered file from many tasks: CSV with one header, one JSON list.

The rows are written once to the shared folder, as a sort by range reads its input twice. They are sorted
by range over the tasks and formatted there, in pieces of ``PIECE_BYTES``. Sums of
the sizes of the pieces before it give each piece its place in the file, and all pieces are written at
their places at the same time; no task sees more than its own. A task that runs again writes the same
bytes to the same place. The file grows under another name and gets its own one when it is whole.

This needs a file system that takes writes at any place of a file: a local or mounted one. For a store of
objects write the parts instead (``write_metrics_csv``, ``write_eval_results``).

A JSON list is read again by many tasks: a writer with an indent of two ends each element on a line of its
own, and line breaks inside of values are escaped (``read_results_file``).
"""

from __future__ import annotations

import csv
import io
import json
import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.session import ship_package, written

PIECE_BYTES = 4 << 20
#: What stands between the elements of a list, each of which is an object.
_BETWEEN = "\n  },\n"


def _place(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: one file needs a file system that takes writes at any place of it")
    return os.path.abspath(parts.path)


def csv_text(batch: pa.RecordBatch) -> str:
    """The rows as Python's csv module writes them; null is an empty cell."""
    text = io.StringIO()
    csv.writer(text).writerows(zip(*(column.to_pylist() for column in batch.columns)))
    return text.getvalue()


def json_text(batch: pa.RecordBatch) -> str:
    """The rows as elements of an indented list, each after a comma."""
    return "".join("," + json.dumps([row], indent=2, default=str)[1:-2] for row in batch.to_pylist())


def write_in_order(
    df: DataFrame, path: str, order: list[str], text: Callable[[pa.RecordBatch], str], head: bytes, tail: bytes, over: int = 0,
    empty: bytes | None = None,
) -> None:
    """Write ``head``, the text of the rows by ``order``, and ``tail`` to one file.

    ``head`` covers the first ``over`` bytes of the rows. Without rows the file is ``empty``, if given.
    """
    target = _place(path)
    ship_package(df.sparkSession)
    df = written(df, "rows")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [part], "place": [place], "bytes": [b"".join(waiting)]},
                pa.schema({"part": pa.int32(), "place": pa.int32(), "bytes": pa.binary()}),
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                waiting.append(text(batch.slice(start, 256)).encode())
                size += len(waiting[-1])
                if size >= PIECE_BYTES:
                    yield piece()
                    place, waiting, size = place + 1, [], 0
        if waiting:
            yield piece()

    found = written(
        df.orderBy(*order).mapInArrow(pieces, "part int, place int, bytes binary"), "pieces"
    ).withColumn("size", F.length("bytes").cast("long"))
    # One row for each task of the sort.
    sizes = sorted(tuple(r) for r in found.groupBy("part").agg(F.sum("size")).collect())
    if not sizes and empty is not None:
        head, tail, over = empty, b"", 0
    start, starts = len(head) - over, []
    for part, size in sizes:
        starts.append((part, start))
        start += size
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        found.select("part", "place", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("inside"))
        .join(df.sparkSession.createDataFrame(starts, "part int, start long"), "part")
        .join(found.select("part", "place", "bytes"), ["part", "place"])
        .select((F.col("start") + F.col("inside")).alias("at"), "bytes")
    )
    growing = f"{os.path.dirname(target)}/.{os.path.basename(target)}.{uuid.uuid4().hex}"
    os.makedirs(os.path.dirname(target), exist_ok=True)
    open(growing, "wb").close()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        with open(growing, "r+b", buffering=0) as file:
            for batch in batches:
                for at, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                    raw = memoryview(raw.as_buffer())
                    while raw:
                        done = os.pwrite(file.fileno(), raw, at)
                        raw, at, count = raw[done:], at + done, count + done
        yield pa.RecordBatch.from_pydict({"count": [count]}, pa.schema({"count": pa.int64()}))

    total = placed.mapInArrow(write, "count long").agg(F.sum("count")).first()[0] or 0
    if total != sum(size for _, size in sizes):
        raise OSError(f"{path}: {total} bytes were written instead of {sum(size for _, size in sizes)}")
    with open(growing, "r+b") as file:
        file.write(head)
        file.seek(0, os.SEEK_END)
        file.write(tail)
    os.replace(growing, target)


def write_metrics_file(wide: DataFrame, path: str, order: list[str] = ("step",)) -> None:
    """One CSV file with one header, rows by ``order``; missing values are empty cells."""
    header = io.StringIO()
    csv.writer(header).writerow(wide.columns)
    write_in_order(wide, path, list(order), csv_text, header.getvalue().encode(), b"")


def write_results_file(results: DataFrame, path: str, order: list[str]) -> None:
    """One JSON list with an indent of two, elements by ``order``; null fields are written."""
    write_in_order(results, path, order, json_text, b"[", b"\n]", over=1, empty=b"[]")


def read_results_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The elements of a list that ``write_results_file`` has written, in no order; a field left out is null.

    Tasks read ranges of the file, as the elements are told apart without what stands before them. Text
    that is no such element fails.
    """
    pieces = spark.read.text(path, lineSep=_BETWEEN).select(
        F.regexp_replace("value", r"\A\[\n|\n\]\z", "").alias("value")
    )
    whole = F.when(F.rlike("value", F.lit(r"\n  \}\z")), F.col("value")).otherwise(F.concat("value", F.lit("\n  }")))
    element = F.from_json(whole, schema, {"mode": "FAILFAST"}).alias("element")
    return pieces.filter("value <> '[]'").select(element).select("element.*")
