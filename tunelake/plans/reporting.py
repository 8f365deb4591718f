"""The report on training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tunelake.constants import CORE_TAGS
from tunelake.operators.catalog import latest_run
from tunelake.operators.gap import gap_summary, overfit_flags, train_eval_gap
from tunelake.operators.series import filter_tags, pivot_metrics
from tunelake.operators.summary import argmin_metric, improvement_of, series_facts, summary_of
from tunelake.session import written


def run_report(metrics: DataFrame, tags: list[str] = CORE_TAGS) -> dict[str, DataFrame]:
    """Summary, improvement, lowest values, gap, its trend, overfitting flags and the wide table.

    The facts of the series and the gap table are written once because further tables are made from
    them.
    """
    kept = filter_tags(metrics, tags)
    facts = written(series_facts(kept), "facts")
    gap = written(train_eval_gap(kept), "gap")
    return {
        "summary": summary_of(facts),
        "improvement": improvement_of(facts),
        "lowest": argmin_metric(kept),
        "gap": gap,
        "gap_summary": gap_summary(gap),
        "overfit": overfit_flags(gap),
        "wide": pivot_metrics(kept, tags),
    }


def latest_run_metrics(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metrics of the newest run; the one run name prunes a table partitioned by run."""
    newest = latest_run(runs).select("run").first()
    if newest is None:
        raise LookupError("no run found")
    return metrics.filter(metrics["run"] == newest["run"])
