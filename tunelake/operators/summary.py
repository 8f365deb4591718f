"""Aggregates over run metrics. All combine partial results before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.constants import EPOCH, EVAL_LOSS, LEARNING_RATE
from tunelake.operators.series import filter_tags


def series_facts(metrics: DataFrame) -> DataFrame:
    """First and final value, extremes, sum and number of values of every series.

    First and final go by step and then by place read. The values of a step are settled first, by
    place; after that every step has one row and the step alone orders. Both levels keep plain
    numbers and so stay hash aggregations, for places of any size.
    """
    steps = metrics.groupBy("run", "tag", "step").agg(
        F.min_by("value", "ord").alias("first"),
        F.max_by("value", "ord").alias("final"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        F.sum("value").alias("total"),
        F.count("value").alias("counted"),
        F.count(F.lit(1)).alias("rows"),
    )
    return steps.groupBy("run", "tag").agg(
        F.min_by("first", "step").alias("first_value"),
        F.max_by("final", "step").alias("final_value"),
        F.min("lowest").alias("min_value"),
        F.max("highest").alias("max_value"),
        F.try_divide(F.sum("total"), F.sum("counted")).alias("mean_value"),
        F.sum("rows").alias("rows"),
    )


def summary_of(facts: DataFrame) -> DataFrame:
    """The summary in ``series_facts``."""
    return facts.drop("first_value", "rows")


def summarise_metrics(metrics: DataFrame) -> DataFrame:
    """Final value (the last one read at the last step), minimum, maximum and mean of every series."""
    return summary_of(series_facts(metrics))


def improvement_pct(metrics: DataFrame) -> DataFrame:
    """How far a loss fell from its first to its final value, in percent of the first.

    Tags with ``loss`` in their name and more than one value; null where the first value is zero.
    """
    return improvement_of(series_facts(metrics.filter(F.contains(F.lower("tag"), F.lit("loss")))))


def improvement_of(facts: DataFrame) -> DataFrame:
    """The improvement in ``series_facts``."""
    fell = F.try_divide(F.col("first_value") - F.col("final_value"), F.col("first_value"))
    return (
        facts.filter(F.contains(F.lower("tag"), F.lit("loss")))
        .filter(F.col("rows") > 1)
        .select("run", "tag", "first_value", "final_value", (fell * 100).alias("improvement_pct"))
    )


def argmin_metric(metrics: DataFrame) -> DataFrame:
    """Lowest value of every series and the step where it first occurs.

    Equal values are settled first, so that the value alone orders and both levels hash.
    """
    values = (
        metrics.filter(F.col("value").isNotNull())
        .groupBy("run", "tag", "value")
        .agg(F.min("step").alias("step"))
    )
    return values.groupBy("run", "tag").agg(
        F.min("value").alias("min_value"), F.min_by("step", "value").alias("min_step")
    )


def peak_and_final(metrics: DataFrame) -> DataFrame:
    """Peak and final learning rate and final epoch of every run."""
    rate, epoch = F.col("tag") == LEARNING_RATE, F.col("tag") == EPOCH
    return (
        series_facts(filter_tags(metrics, [LEARNING_RATE, EPOCH]))
        .groupBy("run")
        .agg(
            F.max(F.when(rate, F.col("max_value"))).alias("peak_learning_rate"),
            F.max(F.when(rate, F.col("final_value"))).alias("final_learning_rate"),
            F.max(F.when(epoch, F.col("final_value"))).alias("final_epoch"),
        )
    )


def best_run(metrics: DataFrame, tag: str = EVAL_LOSS) -> DataFrame:
    """The best value of every run, best run first."""
    return (
        filter_tags(metrics, [tag])
        .groupBy("run")
        .agg(F.min("value").alias("best_value"))
        .orderBy("best_value", "run")
    )


def run_throughput(metrics: DataFrame, n_examples: int, epochs: int) -> DataFrame:
    """Duration and speed of every run from its wall times and last step."""
    return (
        metrics.groupBy("run")
        .agg(
            (F.max("wall_time") - F.min("wall_time")).alias("seconds"),
            F.max("step").alias("steps"),
        )
        .withColumns(
            {
                "hours": F.col("seconds") / 3600,
                "samples_per_second": F.try_divide(
                    F.lit(float(n_examples * epochs)), F.col("seconds")
                ),
                "steps_per_second": F.try_divide(F.col("steps").cast("double"), F.col("seconds")),
            }
        )
    )


def run_cost(throughput: DataFrame, hourly_rate: float) -> DataFrame:
    """Cost of every run, and of the machine for a day and for a month of thirty days."""
    rate = F.lit(float(hourly_rate))
    return throughput.select(
        "run",
        "hours",
        (F.col("hours") * rate).alias("cost"),
        (rate * 24).alias("daily_cost"),
        (rate * 24 * 30).alias("monthly_cost"),
    )
