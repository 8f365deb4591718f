"""What several of the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.session import ship_package


#: Rows of a batch that are worked on at a time.
ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_one(columns: list[str]) -> Column:
    """Columns of the input as one, ``own``: whatever their names, none meets a name used on the way."""
    fields = [F.col(f"`{c}`").alias(c) for c in columns]
    return F.struct(*(fields or [F.lit(True).alias("none")])).alias("own")


def out_of_one(columns: list[str], **apart: str) -> list[Column]:
    """The columns that ``in_one`` has put together; ``apart``: where columns kept beside it are now."""
    of = {own: now for now, own in apart.items()}
    return [(F.col(of[c]) if c in of else F.col("own").getField(c)).alias(c) for c in columns]


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``ROWS`` at most at a time: few Python objects, however many rows a task has."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def give_back() -> None:
    """Return what this process has freed to the system: workers are kept, and others need the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    release: Callable[[], None] | None = None,
) -> DataFrame:
    """Run ``function`` on small Arrow batches of ``df`` in the Python workers.

    ``release`` lets go of what a worker remembers, at the end of each task.
    """
    ship_package(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(function, small_batches(batches))
        if release is not None:
            release()
            give_back()

    return df.mapInArrow(each, schema)


class BoundedCache(dict):
    """A dict that makes missing values itself and starts afresh when it is full."""

    def __init__(self, make: Callable, entries: int, longest: int) -> None:
        super().__init__()
        self._make, self._entries, self._longest = make, entries, longest

    def __missing__(self, key):
        value = self._make(key)
        if len(key) <= self._longest:
            if len(self) >= self._entries:
                self.clear()
            self[key] = value
        return value
