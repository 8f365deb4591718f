"""Tokenising, truncation and padded batches."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.constants import IGNORED_LABEL
from tunelake.functions.text import strip
from tunelake.operators.ranking import rank_in_groups
from tunelake.session import written

# texts in, one list of token ids for each text out
Encode = Callable[[list[str]], list[list[int]]]

_loaded: dict[str, Encode] = {}


def _encoder_of_process(call: str, factory: Callable[[], Encode]) -> Encode:
    """The encoder of one call of ``encoder_ids``; a worker keeps that of the latest call only."""
    if call not in _loaded:
        _loaded.clear()
        _loaded[call] = factory()
    return _loaded[call]


def word_ids(text: Column, vocabulary: int = 1 << 17) -> Column:
    """Ids of the words between white space, by hash; needs no model file and no Python worker."""
    words = F.split(strip(text), r"\s+")
    ids = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(vocabulary)).cast("int"))
    return F.when(strip(text) == "", F.array().cast("array<int>")).otherwise(ids)


def character_ids(text: Column) -> Column:
    """Ids of the characters, by code point."""
    ids = F.transform(F.split(text, ""), F.ascii)
    return F.when(text == "", F.array().cast("array<int>")).otherwise(ids)


def encoder_ids(text: Column, encoder_factory: Callable[[], Encode]) -> Column:
    """Ids by a user's tokenizer, made once in each Python worker, by Arrow batches."""
    call = uuid.uuid4().hex

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder_of_process(call, encoder_factory)
        for batch in batches:
            yield pd.Series(encoder(batch.tolist()), dtype=object)

    return encode(text)


def tokenize(
    df: DataFrame,
    ids: Column | None = None,
    max_len: int = 2048,
    text: str = "text",
) -> DataFrame:
    """Replace the text by ``input_ids, attention_mask, n_tokens, length, was_truncated``; no padding.

    The whole text is tokenised; ``n_tokens`` counts before truncation to ``max_len`` and ``length``
    after it. ``ids`` is one of the id expressions above (words by default).
    """
    tokenised = df.withColumn("_ids", word_ids(F.col(text)) if ids is None else ids)
    n = F.size("_ids")
    return (
        tokenised.withColumn("n_tokens", n)
        .withColumn("length", F.least(n, F.lit(max_len)))
        .withColumn("was_truncated", n > max_len)
        .withColumn("input_ids", F.slice("_ids", 1, max_len))
        .withColumn("attention_mask", F.array_repeat(F.lit(1), F.col("length")))
        .drop("_ids", text)
    )


def batch_rows(
    lengths: DataFrame,
    order: list[str],
    length: str,
    batch_size: int = 4,
    group: list[str] = (),
) -> DataFrame:
    """Consecutive batches of narrow rows: adds ``batch_id`` and ``batch_length`` (longest member).

    Each ``group`` has batches of its own, numbered from 0.
    """
    numbered = rank_in_groups(lengths, list(group), order, "_rn")
    in_batch = Window.partitionBy(*group, "batch_id")
    return (
        numbered.withColumn("batch_id", F.floor((F.col("_rn") - 1) / batch_size).cast("bigint"))
        .withColumn("batch_length", F.max(length).over(in_batch))
        .drop("_rn")
    )


def collate(
    tokenised: DataFrame,
    key: str,
    pad_id: int,
    batch_size: int = 4,
    sort_by_length: bool = False,
    group: list[str] = (),
) -> DataFrame:
    """Padded batches of tokenised examples (``key, input_ids, length``), in key order.

    No batch holds rows of two values of ``group`` (such as the split). The table is written once
    with a number for each row, because batching reads lengths first and tokens later.

    Every example is padded on the right to the longest of its batch; the mask is 0 on padding, and
    labels are the ids with every pad id (also one inside the text, where pad and end mark are the
    same) replaced by the ignored label. ``sort_by_length`` batches examples of like length, which
    wastes less padding. Rows that share a key stand next to each other, in any order. Only keys and
    lengths are read and ordered for the batches; the ids move once, to meet their batch by the row
    number, and masks are made where they are used.
    """
    stored = written(
        tokenised.drop("attention_mask").withColumn("_row", F.monotonically_increasing_id()), "tokens"
    )
    order = ["length", key, "_row"] if sort_by_length else [key, "_row"]
    batches = batch_rows(
        stored.select(*group, key, "length", "_row"), order, "length", batch_size, group
    ).select("_row", "batch_id", "batch_length")
    padding = F.col("batch_length") - F.col("length")
    masked = F.transform(
        "input_ids", lambda t: F.when(t == pad_id, F.lit(IGNORED_LABEL)).otherwise(t)
    )
    # The ids are looked through one by one only where the text itself holds the pad id.
    labels = F.when(F.array_contains("input_ids", pad_id), masked).otherwise(F.col("input_ids"))

    def pad(column: Column, value: int) -> Column:
        return F.concat(column, F.array_repeat(F.lit(value), padding))

    return (
        stored.join(batches, "_row")
        .drop("_row")
        .withColumns(
            {
                "labels": pad(labels, IGNORED_LABEL),
                "input_ids": pad(F.col("input_ids"), pad_id),
                "attention_mask": pad(F.array_repeat(F.lit(1), F.col("length")), 0),
                "n_padding": padding,
            }
        )
    )


def padding_waste(collated: DataFrame, group: list[str] = ()) -> DataFrame:
    """Batches, cells and the share of cells that are padding, in percent, for each ``group``."""
    totals = [
        F.max("batch_id").alias("_last"),
        F.sum("batch_length").alias("cells"),
        F.sum("n_padding").alias("padding_cells"),
    ]
    return collated.groupBy(*group).agg(*totals).select(
        *group,
        (F.col("_last") + 1).alias("batches"),
        "cells",
        "padding_cells",
        F.try_divide(F.col("padding_cells") * 100.0, F.col("cells")).alias("waste_pct"),
    )


def steps_for(
    n_examples: int, batch_size: int, accumulation: int, epochs: int, max_steps: int = -1
) -> int:
    """Optimiser steps of a run: all epochs, or ``max_steps`` where that is set."""
    if max_steps > 0:
        return max_steps
    return math.ceil(n_examples / (batch_size * accumulation)) * epochs


def batch_plan(
    examples: DataFrame,
    batch_size: int = 4,
    accumulation: int = 4,
    epochs: int = 5,
    max_steps: int = -1,
) -> DataFrame:
    """Effective batch and number of steps for a table of examples.

    Saving is off in runs of less than fifty steps that were asked for by ``max_steps``.
    """
    effective = batch_size * accumulation
    by_epochs = F.ceil(F.col("examples") / effective).cast("bigint") * epochs
    return examples.agg(F.count(F.lit(1)).alias("examples")).select(
        "examples",
        F.lit(effective).alias("effective_batch"),
        (F.lit(max_steps).cast("bigint") if max_steps > 0 else by_epochs).alias("total_steps"),
        F.lit(not 0 < max_steps < 50).alias("saves_checkpoints"),
    )
