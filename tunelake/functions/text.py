"""Text expressions whose results equal Python's string methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's trim removes the space only.
PY_WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def strip(text: Column) -> Column:
    """``text.strip()``."""
    return F.btrim(text, F.lit(PY_WHITESPACE))


def strip_prompt(full_output: Column, prompt: Column) -> Column:
    """What follows the prompt, stripped.

    Positional: as many characters are cut as the prompt is long, whatever they are.
    """
    return strip(F.substr(full_output, F.length(prompt) + 1))


def after_last_marker(text: Column, marker: str) -> Column:
    """What follows the last ``marker``, stripped; the whole text where there is no marker."""
    return strip(F.substring_index(text, marker, -1))
