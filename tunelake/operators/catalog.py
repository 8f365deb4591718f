"""Runs, checkpoints and artifacts: latest, best, missing, kept and deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.constants import EVAL_LOSS, REQUIRED_ADAPTER_FILES
from tunelake.functions.paths import artifact_kind, checkpoint_step, megabytes
from tunelake.operators.series import filter_tags, first_per_step


def runs_with_logs(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Runs that hold at least one object under ``logs/``, be it only the folder's own entry.

    ``artifacts`` has ``run`` and ``inside``; it is cut to distinct runs before it meets ``runs``.
    """
    logged = artifacts.filter(F.startswith("inside", F.lit("logs/"))).select("run").distinct()
    return runs.join(logged, "run", "left_semi")


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run; of runs with one time the last by name."""
    return runs.orderBy(F.desc("started_at"), F.desc("run")).limit(1)


def select_run(runs: DataFrame, name: str | None = None) -> DataFrame:
    """The run of that name, or the latest where no name is given; an unknown name is an error."""
    if name is None:
        return latest_run(runs)
    chosen = runs.filter(F.col("run") == name)
    if chosen.isEmpty():
        raise LookupError(f"no run named {name!r}")
    return chosen


def list_checkpoints(artifacts: DataFrame) -> DataFrame:
    """Checkpoint folders of each run (``run, step, path``) from artifacts with ``run, inside``."""
    folder = F.substring_index("inside", "/", 1)
    return (
        artifacts.filter(F.startswith("inside", F.lit("checkpoint-")))
        .select("run", checkpoint_step(folder).alias("step"), folder.alias("path"))
        .filter(F.col("step").isNotNull())
        .distinct()
    )


def _one_path(checkpoints: DataFrame) -> DataFrame:
    """One path for each run and step, the last by name, as ``_path``."""
    return checkpoints.groupBy("run", "step").agg(F.max("path").alias("_path"))


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """The checkpoint with the highest step of every run; steps compare as numbers."""
    return (
        _one_path(checkpoints)
        .groupBy("run")
        .agg(F.max("step").alias("_step"), F.max_by("_path", "step").alias("path"))
        .select("run", F.col("_step").alias("step"), "path")
    )


def best_checkpoint(metrics: DataFrame, checkpoints: DataFrame, tag: str = EVAL_LOSS) -> DataFrame:
    """The saved checkpoint with the lowest evaluation loss of every run; of equal ones the first.

    Evaluations at steps that were not saved do not count. The first step of each value is settled
    before the lowest value, so both levels keep plain numbers and stay hash aggregations.
    """
    evaluations = first_per_step(filter_tags(metrics, [tag])).select("run", "step", "value")
    saved = checkpoints.groupBy("run", "step").agg(F.min("path").alias("path"))
    best = (
        evaluations.filter(F.col("value").isNotNull())
        .join(saved.select("run", "step"), ["run", "step"])
        .groupBy("run", "value")
        .agg(F.min("step").alias("first"))
        .groupBy("run")
        .agg(F.min_by("first", "value").alias("step"), F.min("value").alias("value"))
    )
    return best.join(saved, ["run", "step"]).select("run", "step", "value", "path")


def retention_plan(checkpoints: DataFrame, best: DataFrame | None = None, keep: int = 3) -> DataFrame:
    """Which checkpoints stay: the ``keep`` newest of each run, and the best one where given.

    The newest ones are found by a row limit inside each task before the shuffle, so a run with very
    many checkpoints sends few rows.
    """
    newest = Window.partitionBy("run").orderBy(F.desc("step"))
    kept = (
        checkpoints.select("run", "step")
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= keep)
        .select("run", "step")
    )
    if best is not None:
        kept = kept.unionByName(best.select("run", "step"))
    kept = kept.distinct().withColumn("keep", F.lit(True))
    return checkpoints.join(kept, ["run", "step"], "left").withColumn(
        "keep", F.coalesce("keep", F.lit(False))
    )


def missing_required_files(
    runs: DataFrame,
    artifacts: DataFrame,
    required: list[str] = REQUIRED_ADAPTER_FILES,
    folder: str = "final_model",
) -> DataFrame:
    """Required files that a run lacks, one row for each.

    The artifacts shrink to one row of flags for each run before the join.
    """
    paths = [f"{folder}/{name}" for name in required]
    present = (
        artifacts.filter(F.col("inside").isin(*paths))
        .groupBy("run")
        .agg(*[F.max(F.col("inside") == p).alias(f"_f{i}") for i, p in enumerate(paths)])
    )
    cells = F.array(
        *[
            F.when(~F.coalesce(F.col(f"_f{i}"), F.lit(False)), F.lit(name))
            for i, name in enumerate(required)
        ]
    )
    return (
        runs.select("run")
        .join(present, "run", "left")
        .select("run", F.explode(F.array_compact(cells)).alias("missing_file"))
    )


def artifact_summary(artifacts: DataFrame, keys: list[str], shown: int = 10) -> DataFrame:
    """Number and size of the artifacts of each group, and how many a short listing leaves out."""
    return artifacts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("objects"),
        F.sum("length").alias("bytes"),
        megabytes(F.sum("length")).alias("megabytes"),
        F.greatest(F.count(F.lit(1)) - shown, F.lit(0)).alias("more"),
    )


def artifacts_exist(artifacts: DataFrame, prefix: str, path: str = "path") -> bool:
    """Whether any artifact lies under the prefix; stops at the first one found."""
    return not artifacts.filter(F.startswith(path, F.lit(prefix))).isEmpty()


def artifact_head(artifacts: DataFrame, keys: list[str], shown: int = 10) -> DataFrame:
    """The short listing itself: the first paths of each group with their size."""
    by_path = Window.partitionBy(*keys).orderBy("path")
    return (
        artifacts.withColumn("place", F.row_number().over(by_path))
        .filter(F.col("place") <= shown)
        .select(*keys, "place", "path", megabytes(F.col("length")).alias("megabytes"))
    )


def head_by_key(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(*key).limit(n)


def cleanup_plan(artifacts: DataFrame, keep_final_model: bool = False, path: str = "path") -> DataFrame:
    """What a clean-up would do with each path: ``kind`` and ``action``. Nothing is deleted."""
    deleted = ["checkpoint", "backup"] + ([] if keep_final_model else ["final_model"])
    return artifacts.withColumn("kind", artifact_kind(F.col(path))).withColumn(
        "action", F.when(F.col("kind").isin(*deleted), "delete").otherwise("keep")
    )
