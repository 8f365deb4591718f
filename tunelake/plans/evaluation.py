"""Run a model over samples and score what it writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.constants import ASSISTANT_MARKER, RECORD_FIELDS
from tunelake.functions.strict_json import extract_json
from tunelake.functions.templates import chat_prompt, inference_prompt
from tunelake.functions.text import after_last_marker, strip_prompt
from tunelake.operators.evaluation import (
    exact_match_accuracy,
    field_accuracy,
    score_predictions,
)
from tunelake.operators.inference import Model, batch_infer
from tunelake.session import written


def recover_records(
    texts: DataFrame,
    model_factory: Callable[[], Model],
    id_column: str = "id",
    fields: list[str] = RECORD_FIELDS,
    **infer_options,
) -> DataFrame:
    """Plain prompt, model, answer after the prompt, record found in it: ``id, generated, record, status``."""
    prompts = texts.select(id_column, inference_prompt(F.col("text")).alias("prompt"))
    outputs = batch_infer(prompts, model_factory, id_column, **infer_options)
    answers = outputs.select(
        id_column, strip_prompt(F.col("full_output"), F.col("prompt")).alias("generated")
    )
    return extract_json(answers, "generated", fields)


def evaluate(
    samples: DataFrame,
    model_factory: Callable[[], Model],
    id_column: str = "id",
    fields: list[str] = RECORD_FIELDS,
    **infer_options,
) -> dict[str, DataFrame]:
    """Score a model on samples with ``instruction, input, expected_json``.

    Model outputs are written once: they are by far the dearest step. So are the scores, which feed
    every table.
    """
    prompts = samples.select(
        id_column, chat_prompt(F.col("instruction"), F.col("input")).alias("prompt")
    )
    outputs = written(
        batch_infer(prompts, model_factory, id_column, **infer_options), "model-outputs"
    )
    predicted = outputs.select(
        id_column, after_last_marker(F.col("full_output"), ASSISTANT_MARKER).alias("predicted_json")
    )
    scored = written(score_predictions(samples, predicted, [id_column], fields), "scores")
    return {
        "scored": scored,
        "accuracy": exact_match_accuracy(scored),
        "field_accuracy": field_accuracy(scored, fields),
    }
