"""Instruction examples from JSON lines, with a reject table for the lines that cannot be used."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tunelake.constants import RECORD_FIELDS
from tunelake.functions.strict_json import (
    is_json,
    record_type,
    stripped_blank,
    with_strict_object,
)
from tunelake.functions.text import strip

_KEYS = ["instruction", "input", "output"]


def parse_example_lines(
    lines: DataFrame,
    line: str = "value",
    fields: list[str] = RECORD_FIELDS,
    counts_name: str | None = None,
) -> DataFrame:
    """Add ``instruction, input, output, reason`` to text lines; ``reason`` is null for good ones.

    Reasons: ``blank``; ``malformed`` (not exactly one JSON value); ``not_object``;
    ``missing_key`` (one of the three keys is absent; a null value is allowed);
    ``output_not_object`` (the answer is neither an object nor null).
    ``lines`` and ``rejected`` are counted as observed metrics under ``counts_name``, which must
    differ between inputs that meet in one plan (a new name by default).
    """
    example_type = f"struct<instruction: string, input: string, output: {record_type(fields)}>"
    text = "_line"
    example = F.col("_example")
    parsed = with_strict_object(
        lines.withColumn(text, strip(F.col(line))), text, example_type, "_example"
    )
    some_null = F.lit(False)
    for key in _KEYS:
        some_null = some_null | example[key].isNull()
    present = F.json_object_keys(text)
    some_absent = F.size(F.array_except(F.array(*[F.lit(k) for k in _KEYS]), present)) > 0
    # A value of the wrong type is read as null; what stands in the text tells it from a real null.
    lost_output = example["output"].isNull() & F.get_json_object(text, "$.output").isNotNull()
    reason = (
        F.when(stripped_blank(F.col(text)), "blank")
        .when(
            example.isNull(), F.when(is_json(F.col(text)), "not_object").otherwise("malformed")
        )
        .when(
            some_null,
            F.when(some_absent, "missing_key").when(lost_output, "output_not_object"),
        )
    )
    out = parsed.withColumn("reason", reason).select(
        *lines.columns, *[example[k].alias(k) for k in _KEYS], "reason"
    )
    # The observed counts also keep later filters above the parse, so a line is parsed once.
    return out.observe(
        counts_name or f"example_lines_{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )


def split_examples(
    parsed: DataFrame, line: str = "value", mode: str = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """Good examples and rejected lines of ``parse_example_lines``.

    ``mode="fail"`` skips blank and malformed lines only, and fails the job on a line that is JSON
    but not a usable example.
    """
    if mode not in ("quarantine", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    rejects = parsed.filter(F.col("reason").isNotNull()).drop(*_KEYS)
    if mode == "quarantine":
        return parsed.filter(F.col("reason").isNull()).drop(line, "reason"), rejects
    skipped = F.coalesce(F.col("reason").isin("blank", "malformed"), F.lit(False))
    stop = F.raise_error(F.concat(F.lit("unusable example: "), F.col("reason")))
    checked = parsed.filter(~skipped).withColumn(
        "instruction",
        F.when(F.col("reason").isNull(), F.col("instruction")).otherwise(stop.cast("string")),
    )
    return checked.drop(line, "reason"), rejects


def read_example_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the file they came from and a number, ``example_id``, unique over all files read.

    The number grows with the place within a file's part; ``with_line_numbers`` makes line numbers.
    """
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.monotonically_increasing_id().alias("example_id"),
    )


def read_placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``read_example_lines`` with the split of the file, ``block``, that each line was read from."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.monotonically_increasing_id().alias("example_id"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def with_line_numbers(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """``rows`` of ``placed`` with ``line_no``, from 1 in each file, instead of ``block``.

    The lines of each split are counted; the number of a line is the sum of the splits before its own
    and its place in there, which is how far its id lies above the first one: a split is read by one
    task, in order. What is counted and joined has one row for each split.
    """
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        placed.groupBy("file_path", "block")
        .agg(F.min("example_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
        .drop("_lines")
    )
    number = F.col("_before") + F.col("example_id") - F.col("_first") + 1
    return rows.join(splits, ["file_path", "block"]).withColumn("line_no", number).select(
        *(c for c in rows.columns if c != "block"), "line_no"
    )


def read_rejects(
    spark: SparkSession, path: str | list[str], fields: list[str] = RECORD_FIELDS, mode: str = "quarantine"
) -> DataFrame:
    """The lines that cannot be used, with their reason and their number in the file."""
    placed = read_placed_lines(spark, path)
    _, rejects = split_examples(parse_example_lines(placed, "value", fields), "value", mode)
    return with_line_numbers(rejects, placed)


def read_examples(
    spark: SparkSession,
    path: str | list[str],
    fields: list[str] = RECORD_FIELDS,
    mode: str = "quarantine",
    counts_name: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Read JSON-lines files: ``(good, rejects)``, both with the file and number of each line.

    A rejected line is kept whole with its reason. The two are separate lazy reads; a caller who
    needs both stores them first (``store_examples``).
    """
    parsed = parse_example_lines(read_example_lines(spark, path), "value", fields, counts_name)
    return split_examples(parsed, "value", mode)


def store_examples(
    parsed: DataFrame, path: str, line: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Write ``parse_example_lines`` output once and give ``(good, rejects)`` from storage.

    For callers who need both: the lines are then read and parsed a single time. The halves lie in
    folders of their own, and only rejected rows keep their line.
    """
    parsed.withColumn("rejected", F.col("reason").isNotNull()).withColumn(
        line, F.when(F.col("rejected"), F.col(line))
    ).write.partitionBy("rejected").parquet(path)
    stored = parsed.sparkSession.read.schema(
        StructType([*parsed.schema.fields, StructField("rejected", BooleanType())])
    ).parquet(path)
    good = stored.filter(~F.col("rejected")).drop(line, "reason", "rejected")
    return good, stored.filter(F.col("rejected")).drop(*_KEYS, "rejected")


def load_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """One table of several splits, each row labelled with its ``split``."""
    labelled = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    if not labelled:
        raise ValueError("no split given")
    out = labelled[0]
    for df in labelled[1:]:
        out = out.unionByName(df)
    return out
