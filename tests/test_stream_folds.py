import random

from pyspark.sql import functions as F

from tunelake.operators.logs import error_rate
from tunelake.sources.metrics import METRICS_SCHEMA
from tunelake.streaming import follow as S


def test_run_state_of_many_batches_and_runs(spark, tmp_path, rows):
    pick = random.Random(6)
    data = [
        (f"r{pick.randrange(40)}", pick.choice(["train/loss", "eval/loss", "train/epoch"]), pick.choice([None, *range(30)]),
         pick.choice([None, 0.5, 1.5, float(n)]), 0.0, n)
        for n in range(900)
    ]
    incoming, folder = str(tmp_path / "in"), str(tmp_path / "state")
    for part in range(5):
        few = spark.createDataFrame(data[part::5], METRICS_SCHEMA)
        few.repartition(2).write.mode("append").parquet(incoming)
        stream = S.follow_table(spark, incoming, METRICS_SCHEMA, files_per_trigger=1)
        out = S.follow_run_state(stream, folder)
    columns = ["run", "global_step", "train_loss", "best_metric"]
    whole = spark.createDataFrame(data, METRICS_SCHEMA)
    assert rows(out, *columns) == rows(S.run_state(whole), *columns)
    # nothing but one row for each run outlives a batch, and no streaming state is kept
    assert out.count() == len({r[0] for r in data})
    assert not (tmp_path / "state" / "state" / "state").exists()
    assert len(list((tmp_path / "state" / "kept").iterdir())) <= 2


def test_tables_are_hash_aggregated(spark):
    plan = S.run_state(spark.createDataFrame([], METRICS_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_kinds_of_bins_count_every_error(spark, tmp_path, rows):
    pick = random.Random(2)
    schema = "ts timestamp, message string"
    incoming, folder = str(tmp_path / "in"), str(tmp_path / "kinds")
    given, final, opened, late, seen = [], {}, {}, {}, None
    for turn in range(6):
        minutes = [max(0, turn * 9 + pick.randrange(-30, 8)) for _ in range(12)]
        batch = [(m, pick.choice(["ERROR x", "fine"])) for m in minutes]
        given += batch
        spark.createDataFrame([(f"2025-01-01 {m // 60:02d}:{m % 60:02d}:30", t) for m, t in batch], "t string, message string").select(
            F.col("t").cast("timestamp").alias("ts"), "message"
        ).coalesce(1).write.mode("append").parquet(incoming)
        out = S.follow_errors(S.follow_table(spark, incoming, schema), folder)
        # the same, bin by bin
        passed = None if seen is None else seen - 10
        for m, text in batch:
            if "ERROR" in text:
                end = m // 5 * 5 + 5
                where = late if passed is not None and end <= passed else opened
                where[end] = where.get(end, 0) + 1
                seen = max(seen or 0, m + 0.5)
        for end in [e for e in opened if seen is not None and e <= seen - 10]:
            final[end] = opened.pop(end)
    expected = [(e, n, kind) for kind, table in (("final", final), ("provisional", opened), ("late", late)) for e, n in table.items()]
    minute = F.hour("bin_end") * 60 + F.minute("bin_end")
    assert rows(out.select(minute.alias("end"), "errors", "kind")) == sorted(expected, key=repr)
    assert late and final and opened
    log = spark.read.schema(schema).parquet(incoming)
    total = rows(out.groupBy("bin_start", "bin_end").agg(F.sum("errors").alias("errors")))
    assert total == rows(error_rate(log).select("bin_start", "bin_end", "errors"))
