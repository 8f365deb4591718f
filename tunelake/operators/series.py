"""Series of run metrics: filtering, ordering, one value per step, running best, alignment.

Steps are cut into blocks of ``block_steps``. After repeats are dropped a run has at most one row per
step, so a block is bounded however long the run is; windows run inside blocks, and a small table
with one row per block carries what the blocks before and after it contribute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.constants import CORE_TAGS, EVAL_LOSS
from tunelake.operators.ranking import rank_in_groups

BLOCK_STEPS = 1 << 18


def column_name(tag: str) -> str:
    """A tag as a column name."""
    return tag.replace("/", "_")


def in_blocks(rows: DataFrame, block_steps: int) -> DataFrame:
    """Add ``block``, which never falls as the step grows; rows without run or step belong to no series.

    The null test stands here, and not in the joins by block, so that both sides of such a join are
    one and the same plan up to their first shuffle and the shuffle is run once for both.
    """
    block = F.floor(F.col("step") / F.lit(block_steps)).cast("bigint")
    return rows.withColumn("block", block).filter(
        F.col("run").isNotNull() & F.col("block").isNotNull()
    )


def filter_tags(metrics: DataFrame, keep: list[str] = CORE_TAGS) -> DataFrame:
    """Rows of the tags to keep."""
    return metrics.filter(F.col("tag").isin(*keep))


def filter_eval_warmup(metrics: DataFrame, min_step: int = 100, tag: str = EVAL_LOSS) -> DataFrame:
    """Drop the evaluations before ``min_step``; other tags stay."""
    return metrics.filter((F.col("tag") != tag) | (F.col("step") >= min_step))


def series_order(metrics: DataFrame) -> DataFrame:
    """Add ``rn``, the place of a row in its series by step; file order settles equal steps."""
    return rank_in_groups(metrics, ["run", "tag"], ["step", "ord"], "rn")


def first_per_step(metrics: DataFrame) -> DataFrame:
    """One row for each run, tag and step: the one that was read first."""
    return metrics.groupBy("run", "tag", "step").agg(
        F.min_by("value", "ord").alias("value"),
        F.min_by("wall_time", "ord").alias("wall_time"),
        F.min("ord").alias("ord"),
    )


def first_values(
    metrics: DataFrame, tags: list[str], keys: list[str | Column] = ("run", "step")
) -> DataFrame:
    """A row for each of ``keys`` and a column for each tag, the first value read for a step.

    One aggregation with partial sums before the shuffle, so a step that repeats often is no burden.
    """
    picked = [
        F.min_by("value", F.when(F.col("tag") == tag, F.col("ord"))).alias(column_name(tag))
        for tag in tags
    ]
    return metrics.filter(F.col("tag").isin(*tags)).groupBy(*keys).agg(*picked)


def pivot_metrics(metrics: DataFrame, tags: list[str] = CORE_TAGS) -> DataFrame:
    """Step-aligned table: a row for each run and step, a column for each tag, null where absent."""
    return first_values(metrics, list(tags))


def align_series(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two single series side by side over the union of their steps.

    Labels the rows and aggregates once instead of a full outer join of two tables.
    """
    labelled = [
        df.withColumn("tag", F.lit(name)) for df, name in zip((left, right), names)
    ]
    return first_values(labelled[0].unionByName(labelled[1]), list(names))


def all_steps(metrics: DataFrame) -> DataFrame:
    """The distinct steps of each run over all its tags."""
    return metrics.select("run", "step").distinct()


def running_best(
    metrics: DataFrame, tag: str = EVAL_LOSS, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """Lowest value so far at every step of a series, and whether the step set it."""
    series = first_values(
        in_blocks(metrics, block_steps), [tag], ["run", "block", "step"]
    ).withColumnRenamed(column_name(tag), "value")
    inside = Window.partitionBy("run", "block").orderBy("step")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    earlier_blocks = (
        Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        series.groupBy("run", "block")
        .agg(F.min("value").alias("block_min"))
        .select("run", "block", F.min("block_min").over(earlier_blocks).alias("carried"))
    )
    return (
        series.withColumn("_before", F.min("value").over(before))
        .join(carried, ["run", "block"])
        .withColumn("_before", F.least("_before", "carried"))
        .select(
            "run",
            "step",
            "value",
            F.least("value", "_before").alias("best_value"),
            F.coalesce(F.col("value") < F.col("_before"), F.col("value").isNotNull()).alias(
                "is_new_best"
            ),
        )
    )
