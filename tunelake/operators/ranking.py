"""Row numbers over groups of any size.

Rows are range-partitioned on group and order together, so a group that holds a third of the table is
spread over a third of the partitions; a row's number is its place in its partition plus the rows of
its group before it. There is one plan for every size: nothing is counted beforehand and no group is
ever brought to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.session import written


def rank_in_groups(
    df: DataFrame, group: list[str], order: list[str], into: str = "rn"
) -> DataFrame:
    """Add ``into``: 1, 2, 3 … within ``group`` by ``order``.

    ``group`` and ``order`` together should be unique; rows equal in all of them are numbered in any
    order. Runs one job that writes the ordered rows to the shared folder, because the numbers must
    not change when a lost task is run again. The number of partitions is left to adaptive execution
    (``spark.sql.adaptive.coalescePartitions.initialPartitionNum``), which joins neighbours only.
    """
    keys = [*group, *order]
    placed = written(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_chunk", F.shiftright("_place", 33)),
        "ranked",
    )
    chunks = placed.groupBy(*group, "_chunk").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # At most one row for each partition of a group, whatever the group holds.
    earlier = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = chunks.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_chunk").alias("_g_chunk"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_shift"),
    )
    same = F.col("_chunk") == F.col("_g_chunk")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return placed.join(offsets, same).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias(into)
    )
