"""Writers. Each writes from all tasks; none gathers its rows in one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_metrics_csv(wide: DataFrame, path: str, order: list[str] = ("step",)) -> None:
    """Write a step-aligned table as CSV with a header; missing values are empty cells.

    Rows ascend over the part files in name order, so the parts joined are the sorted table.
    """
    wide.orderBy(*order).write.option("header", "true").csv(path)


def write_eval_results(results: DataFrame, path: str) -> None:
    """Write evaluation rows as JSON lines; null fields are written."""
    results.write.option("ignoreNullFields", "false").json(path)


def write_run_partitioned(df: DataFrame, base: str, run: str, format: str = "parquet") -> str:
    """Write under ``base/run=<run>`` and refuse to touch a run that is already there."""
    path = f"{base.rstrip('/')}/run={run}"
    df.write.mode("errorifexists").format(format).save(path)
    return path


def write_runs_partitioned(df: DataFrame, base: str) -> None:
    """Write all runs of ``df`` (column ``run``) in one pass, each under ``base/run=<run>``.

    Refuses, before anything is written, where one of the runs is already there.
    """
    try:
        present = df.sparkSession.read.parquet(base).select(F.col("run").cast("string"))
    except AnalysisException:
        present = None  # nothing is there yet
    if present is not None:
        again = df.select(F.col("run").cast("string")).distinct().join(present.distinct(), "run", "left_semi")
        if not again.isEmpty():
            raise FileExistsError(f"a run is already there: {again.first()['run']}")
    df.write.mode("append").partitionBy("run").parquet(base)
