"""Gap between training and evaluation loss, and what can be read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.constants import EVAL_LOSS, TRAIN_LOSS
from tunelake.operators.series import BLOCK_STEPS, column_name, first_values, in_blocks


def _next_known(value: str, group: str, order: str) -> Column:
    """The next value after a row that is not null; shares the sort of what looks back.

    A frame that reaches forward to the end would be read again for every row.
    """
    return F.expr(f"lead({value}) ignore nulls over (partition by {group} order by {order})")


def train_eval_gap(
    metrics: DataFrame,
    min_step: int = 100,
    train_tag: str = TRAIN_LOSS,
    eval_tag: str = EVAL_LOSS,
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Evaluation loss minus training loss at every evaluation from ``min_step`` on.

    The training loss is interpolated linearly between its neighbours, taken as it is on an equal
    step, and held at its first or last value outside its range. Of a repeated step the first value
    counts. Runs without any training loss give no row.
    Result: ``run, step, eval_loss, train_loss, gap``.
    """
    train, evaluated = column_name(train_tag), column_name(eval_tag)
    steps = first_values(
        in_blocks(metrics, block_steps), [train_tag, eval_tag], ["run", "block", "step"]
    )
    train_step = F.when(F.col(train).isNotNull(), F.col("step"))
    point = F.when(
        F.col(train).isNotNull(), F.struct(F.col("step").alias("s"), F.col(train).alias("v"))
    )

    # What the nearest blocks on either side end and begin with, for blocks with evaluations.
    ends = steps.groupBy("run", "block").agg(
        F.max(train_step).alias("last_s"),
        F.max_by(train, train_step).alias("last_v"),
        F.min(train_step).alias("first_s"),
        F.min_by(train, train_step).alias("first_v"),
        F.count(evaluated).alias("evaluations"),
    )
    blocks = Window.partitionBy("run").orderBy("block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.withColumns(
            {
                "before_s": F.last("last_s", ignorenulls=True).over(earlier),
                "before_v": F.last("last_v", ignorenulls=True).over(earlier),
                "after_s": _next_known("first_s", "run", "block"),
                "after_v": _next_known("first_v", "run", "block"),
            }
        )
        .filter(F.col("evaluations") > 0)
        .select("run", "block", "before_s", "before_v", "after_s", "after_v")
    )

    so_far = (
        Window.partitionBy("run", "block")
        .orderBy("step")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    around = (
        steps.withColumn("point", point)
        .withColumns(
            {
                "lo": F.last("point", ignorenulls=True).over(so_far),
                "hi": F.coalesce(F.col("point"), _next_known("point", "run, block", "step")),
            }
        )
        .filter(F.col(evaluated).isNotNull() & (F.col("step") >= min_step))
        .join(carried, ["run", "block"])
    )
    lo_s, lo_v = F.coalesce("lo.s", "before_s"), F.coalesce("lo.v", "before_v")
    hi_s, hi_v = F.coalesce("hi.s", "after_s"), F.coalesce("hi.v", "after_v")
    between = around.select(
        "run",
        "step",
        F.col(evaluated).alias("eval_loss"),
        lo_s.alias("lo_s"),
        lo_v.alias("lo_v"),
        hi_s.alias("hi_s"),
        hi_v.alias("hi_v"),
    ).filter(F.col("lo_v").isNotNull() | F.col("hi_v").isNotNull())
    slope = (F.col("hi_v") - F.col("lo_v")) / (F.col("hi_s") - F.col("lo_s"))
    train_loss = (
        F.when(F.col("lo_s").isNull(), F.col("hi_v"))
        .when(F.col("hi_s").isNull() | (F.col("hi_s") == F.col("lo_s")), F.col("lo_v"))
        .otherwise(slope * (F.col("step") - F.col("lo_s")) + F.col("lo_v"))
    )
    return between.select("run", "step", "eval_loss", train_loss.alias("train_loss")).withColumn(
        "gap", F.col("eval_loss") - F.col("train_loss")
    )


def gap_summary(gap: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Mean gap, final gap and trend of each run; a run without gap rows gives no row."""
    change = F.col("final_gap") - F.col("_first")
    return (
        gap.groupBy("run")
        .agg(
            F.avg("gap").alias("mean_gap"),
            F.max_by("gap", "step").alias("final_gap"),
            F.min_by("gap", "step").alias("_first"),
        )
        .withColumn(
            "trend",
            F.when(F.abs(change) < tolerance, "stable")
            .when(change > 0, "increasing")
            .otherwise("decreasing"),
        )
        .drop("_first")
    )


def overfit_flags(
    gap: DataFrame,
    max_gap: float = 0.3,
    max_train_loss: float = 2.0,
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Signs of overfitting at every evaluation.

    ``overfitting``: since the evaluation before, training loss fell and evaluation loss rose (false
    at the first one). ``gap_on_target`` and ``train_on_target`` compare with the given limits.
    """
    rows = in_blocks(gap, block_steps)
    ends = rows.groupBy("run", "block").agg(
        F.max_by("train_loss", "step").alias("t"), F.max_by("eval_loss", "step").alias("e")
    )
    blocks = Window.partitionBy("run").orderBy("block")
    carried = ends.select(
        "run",
        "block",
        F.lag("t").over(blocks).alias("carried_t"),
        F.lag("e").over(blocks).alias("carried_e"),
    )
    inside = Window.partitionBy("run", "block").orderBy("step")
    before = rows.withColumns(
        {"_t": F.lag("train_loss").over(inside), "_e": F.lag("eval_loss").over(inside)}
    ).join(carried, ["run", "block"])
    fell = F.col("train_loss") < F.coalesce("_t", "carried_t")
    rose = F.col("eval_loss") > F.coalesce("_e", "carried_e")
    return before.select(
        "run",
        "step",
        "train_loss",
        "eval_loss",
        "gap",
        F.coalesce(fell & rose, F.lit(False)).alias("overfitting"),
        (F.col("gap") < max_gap).alias("gap_on_target"),
        (F.col("train_loss") < max_train_loss).alias("train_on_target"),
    )
