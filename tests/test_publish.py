import os
import threading

import pytest
from pyspark.sql import functions as F

from tunelake.sources import publish as P


@pytest.fixture
def runs(spark):
    def make(*names, rows=3):
        return spark.createDataFrame([(n, i, float(i)) for n in names for i in range(rows)], "run string, step long, value double")

    return make


def test_runs_are_published_together(spark, tmp_path, runs, rows):
    base = f"file://{tmp_path}/runs"
    schema = runs().schema
    assert rows(P.published_runs(spark, base, schema)) == []
    P.publish_runs(runs("20250101_000000", "5", rows=2), base)
    P.publish_runs(runs("a b"), base)
    found = rows(P.published_runs(spark, base, schema), "run", "step")
    assert found == sorted([("20250101_000000", 0), ("20250101_000000", 1), ("5", 0), ("5", 1), *(("a b", i) for i in range(3))])
    with pytest.raises(FileExistsError, match="run=5"):
        P.publish_runs(runs("6", "5"), base)
    assert rows(P.published_runs(spark, base, schema), "run", "step") == found
    assert len(os.listdir(tmp_path / "runs" / "data")) == 2  # what lost is gone


def test_a_failure_between_two_runs_shows_nothing(spark, tmp_path, runs):
    base = str(tmp_path / "runs")
    broken = runs("first", "second").withColumn(
        "value", F.when(F.col("run") == "second", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value"))
    )
    with pytest.raises(Exception, match="lost"):
        P.publish_runs(broken.repartition(2, "run"), base)
    assert P.published_runs(spark, base, broken.schema).count() == 0
    P.publish_runs(runs("first", "second"), base)
    assert P.published_runs(spark, base, broken.schema).count() == 6


def test_two_writers_of_one_run(spark, tmp_path, runs, rows, monkeypatch):
    """Both have written and looked before either publishes; one of them loses."""
    base = str(tmp_path / "runs")
    together, create = threading.Barrier(2), P._create
    waited = threading.local()

    def late(*args):
        if not getattr(waited, "done", False):
            waited.done = True
            together.wait(60)
        return create(*args)

    monkeypatch.setattr(P, "_create", late)
    outcome = []

    def write(*names):
        try:
            P.publish_runs(runs(*names), base)
            outcome.append("won")
        except FileExistsError:
            outcome.append("lost")

    writers = [threading.Thread(target=write, args=names) for names in (("a", "b"), ("b", "c"))]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(outcome) == ["lost", "won"]
    shown = {r[0] for r in rows(P.published_runs(spark, base, runs().schema), "run")}
    assert shown in ({"a", "b"}, {"b", "c"})
    assert P.published_runs(spark, base, runs().schema).filter("run = 'b'").count() == 3


def test_writers_of_different_runs_both_win(spark, tmp_path, runs, rows):
    base = str(tmp_path / "runs")
    writers = [threading.Thread(target=P.publish_runs, args=(runs(n), base)) for n in "abcd"]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert {r[0] for r in rows(P.published_runs(spark, base, runs().schema), "run")} == set("abcd")
