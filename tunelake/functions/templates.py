"""Prompt and training-text templates.

A null instruction or input is printed as ``None``, which is what Python string formatting does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake import constants as K
from tunelake.functions.strict_json import dumps_record


def _shown(value: Column, null_text: str) -> Column:
    return F.coalesce(value.cast("string"), F.lit(null_text))


def chat_prompt(
    instruction: Column,
    text: Column,
    system_prompt: str = K.SYSTEM_PROMPT,
    null_text: str = "None",
) -> Column:
    """The chat template up to the point where the assistant answers."""
    return F.concat(
        F.lit(K.BEGIN_OF_TEXT + K.SYSTEM_HEADER + system_prompt + K.END_OF_TURN + K.USER_HEADER),
        _shown(instruction, null_text),
        F.lit("\n\nText: "),
        _shown(text, null_text),
        F.lit(K.END_OF_TURN + K.ASSISTANT_MARKER + "\n\n"),
    )


def training_text(
    instruction: Column,
    text: Column,
    output_json: Column,
    system_prompt: str = K.SYSTEM_PROMPT,
    null_text: str = "None",
) -> Column:
    """One training text: the chat prompt, the answer and the end-of-turn mark."""
    return F.concat(
        chat_prompt(instruction, text, system_prompt, null_text), output_json, F.lit(K.END_OF_TURN)
    )


def inference_prompt(text: Column, instruction: str = K.INFERENCE_INSTRUCTION) -> Column:
    """The plain prompt: instruction, text, request for JSON."""
    return F.concat(
        F.lit(instruction + "\n\n"), _shown(text, "None"), F.lit("\n\n" + K.INFERENCE_SUFFIX)
    )


def format_training_text(
    examples: DataFrame,
    fields: list[str] = K.RECORD_FIELDS,
    system_prompt: str = K.SYSTEM_PROMPT,
    null_text: str = "None",
) -> DataFrame:
    """Replace ``instruction, input, output`` by one ``text`` column; other columns stay."""
    text = training_text(
        F.col("instruction"),
        F.col("input"),
        dumps_record(F.col("output"), fields),
        system_prompt,
        null_text,
    )
    return examples.withColumn("text", text).drop("instruction", "input", "output")
