"""Application logs: ``time | LEVEL | name:function:line - message`` lines, plain or gzipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def time_of(text: Column) -> Column:
    """A time written ``YYYY-MM-DD HH:MM:SS``, null for any other text."""
    return F.when(F.rlike(text, F.lit(_TIME)), text.try_cast("timestamp"))


def parse_app_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add ``logged_at, level, name, function, line_no, message, parsed``.

    A line of another form (the rest of a message over several lines) is kept as a message with
    ``parsed = false`` and nulls elsewhere.
    """
    place, rest = F.col("_place"), F.col("_rest")
    staged = (
        lines.withColumn("_parts", F.split(F.col(line), r" *\| ", 3))
        .withColumn("_rest", F.get("_parts", F.lit(2)))
        .withColumn("_place", F.substring_index("_rest", " - ", 1))
        .withColumns(
            {
                "logged_at": time_of(F.get("_parts", F.lit(0))),
                "line_no": F.substring_index("_place", ":", -1).try_cast("int"),
            }
        )
    )
    is_record = F.coalesce(
        F.col("logged_at").isNotNull()
        & F.col("line_no").isNotNull()
        & (F.length(place) < F.length(rest)),
        F.lit(False),
    )
    fields = {
        "logged_at": F.col("logged_at"),
        "level": F.get("_parts", F.lit(1)),
        "name": F.substring_index(place, ":", 1),
        "function": F.split_part(place, F.lit(":"), F.lit(2)),
        "line_no": F.col("line_no"),
    }
    message = F.substr(rest, F.length(place) + 4)
    return (
        staged.withColumn("parsed", is_record)
        .withColumns(
            {
                **{name: F.when(F.col("parsed"), value) for name, value in fields.items()},
                "message": F.when(F.col("parsed"), message).otherwise(F.col(line)),
            }
        )
        .select(*lines.columns, "parsed", *fields, "message")
    )


def read_app_log(
    spark: SparkSession, path: str | list[str], newer_than: Column | None = None
) -> DataFrame:
    """Read log files (``.gz`` ones too); ``newer_than`` drops dated lines that are older."""
    log = parse_app_log(spark.read.text(path)).drop("value")
    if newer_than is not None:
        log = log.filter(F.col("logged_at").isNull() | (F.col("logged_at") >= newer_than))
    return log
