"""Facts about a table of examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.constants import RECORD_FIELDS


def count_examples(examples: DataFrame) -> DataFrame:
    """Examples in each split."""
    return examples.groupBy("split").agg(F.count(F.lit(1)).alias("examples"))


def profile_dataset(
    examples: DataFrame,
    n_tokens: str = "n_tokens",
    output: str = "output",
    fields: list[str] = RECORD_FIELDS,
    max_len: int = 2048,
) -> DataFrame:
    """Rows, mean and highest token count, rows over the limit, fields, and null share of each field."""
    return examples.agg(
        F.count(F.lit(1)).alias("examples"),
        F.avg(n_tokens).alias("mean_tokens"),
        F.max(n_tokens).alias("max_tokens"),
        F.count_if(F.col(n_tokens) > max_len).alias("over_limit"),
        F.lit(len(fields)).alias("fields"),
        *[
            F.avg(F.col(output)[f].isNull().cast("double")).alias(f"{f}_null_share")
            for f in fields
        ],
    )
