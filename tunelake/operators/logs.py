"""Queries over log tables with a time column and a message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search_log(
    log: DataFrame,
    term: str,
    since: Column | None = None,
    message: str = "message",
    time: str = "ts",
) -> DataFrame:
    """Rows whose message holds ``term``, from ``since`` on."""
    found = log.filter(F.contains(F.col(message), F.lit(term)))
    return found if since is None else found.filter(F.col(time) >= since)


def extract_loss(log: DataFrame, message: str = "message", time: str = "ts") -> DataFrame:
    """Messages about a loss with the value after ``'loss':`` as ``loss``, newest first.

    Messages without such a value keep a null.
    """
    value = F.regexp_extract(F.col(message), r"'loss': ([^,]*),", 1).try_cast("double")
    return newest_first(
        search_log(log, "loss", message=message).withColumn("loss", value), time
    )


def newest_first(log: DataFrame, time: str = "ts") -> DataFrame:
    """Rows by falling time, those of one time in the order read: for a final listing.

    The place read is part of the sort key, so a time that very many rows share is still spread over
    tasks.
    """
    placed = log.withColumn("_place", F.monotonically_increasing_id())
    return placed.orderBy(F.desc(time), "_place").drop("_place")


def error_rate(
    log: DataFrame,
    every: str = "5 minutes",
    term: str = "ERROR",
    message: str = "message",
    time: str = "ts",
) -> DataFrame:
    """Messages that hold ``term`` per time bin; bins without any give no row.

    Works on a stream as it does on a table; give the stream a watermark first.
    """
    return (
        search_log(log, term, message=message)
        .groupBy(F.window(time, every).alias("bin"))
        .agg(F.count(F.lit(1)).alias("errors"))
        .select(F.col("bin.start").alias("bin_start"), F.col("bin.end").alias("bin_end"), "errors")
    )
