"""From JSON lines to tokenised and padded training tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tunelake.constants import RECORD_FIELDS
from tunelake.functions.templates import format_training_text
from tunelake.operators.tokens import collate, tokenize
from tunelake.session import new_folder
from tunelake.sources.examples import (
    load_splits,
    parse_example_lines,
    read_example_lines,
    store_examples,
)


def training_texts(examples: DataFrame, fields: list[str] = RECORD_FIELDS) -> DataFrame:
    """Good examples as one text column next to the columns they are known by."""
    return format_training_text(examples, fields)


def prepare_training_table(
    spark: SparkSession,
    paths: dict[str, str],
    ids: Column | None = None,
    max_len: int = 2048,
    fields: list[str] = RECORD_FIELDS,
) -> tuple[DataFrame, DataFrame]:
    """Read each split's files; give ``(tokenised, rejects)``, both with a ``split`` column.

    Each split is read and parsed once and stored; good and rejected lines come from there, with
    ``file_path`` and ``example_id``, which is unique in its split. Templates and tokens are a lazy
    plan without a shuffle on top.
    """
    good, rejected = {}, {}
    for split, path in paths.items():
        parsed = parse_example_lines(read_example_lines(spark, path), "value", fields)
        good[split], rejected[split] = store_examples(parsed, new_folder(spark, "examples"))
    texts = training_texts(load_splits(good), fields)
    return tokenize(texts, ids, max_len), load_splits(rejected)


def training_batches(
    tokenised: DataFrame, pad_id: int, batch_size: int = 4, sort_by_length: bool = False
) -> DataFrame:
    """Padded batches of ``prepare_training_table``; each split has batches of its own."""
    return collate(tokenised, "example_id", pad_id, batch_size, sort_by_length, ["split"])
