import gzip

import pytest
from pyspark.sql import functions as F

from tunelake.operators import logs as L
from tunelake.sources.logs import read_app_log
from tunelake.sources.metrics import METRICS_SCHEMA
from tunelake.streaming import follow as S

LINES = [
    "2025-11-10 12:00:01 | INFO     | tuner.train:main:12 - Loading | a - b | c",
    "2025-11-10 12:00:02 | WARNING  | tuner.train:load:7 - ",
    "2025-11-12 12:00:02 | SUCCESS  | __main__:<module>:101 - done: 5",
    "Traceback (most recent call last):",
    "",
    "2025-13-10 12:00:02 | INFO     | a:b:1 - bad month",
]


def test_app_log(spark, tmp_path, rows):
    (tmp_path / "app.log").write_text("\n".join(LINES[:3]) + "\n")
    with gzip.open(tmp_path / "app.1.log.gz", "wt") as f:
        f.write("\n".join(LINES[3:]) + "\n")
    log = read_app_log(spark, str(tmp_path)).withColumn("at", F.date_format("logged_at", "dd HH:mm:ss"))
    assert rows(log.filter("parsed"), "at", "level", "name", "function", "line_no", "message") == [
        ("10 12:00:01", "INFO", "tuner.train", "main", 12, "Loading | a - b | c"),
        ("10 12:00:02", "WARNING", "tuner.train", "load", 7, ""),
        ("12 12:00:02", "SUCCESS", "__main__", "<module>", 101, "done: 5"),
    ]
    assert rows(log.filter("not parsed"), "message", "level") == sorted([(t, None) for t in LINES[3:]], key=repr)
    recent = read_app_log(spark, str(tmp_path), F.lit("2025-11-12 00:00:00").cast("timestamp"))
    assert recent.filter("parsed").count() == 1 and recent.count() == 4


@pytest.fixture
def log(make):
    return make(
        [(1, "2025-01-01 00:04:59", "ERROR x"), (2, "2025-01-01 00:05:00", "an ERROR"), (3, "2025-01-01 00:09:59", "ERROR"),
         (4, "2025-01-01 00:06:00", "error"), (5, "2025-01-01 01:00:00", "{'loss': 2.5, 'step': 10}"),
         (6, "2025-01-01 02:00:00", "{'loss': nothing, 'step': 10}"), (7, "2025-01-01 03:00:00", "loss")],
        "id int, t string, message string",
    ).select("id", F.col("t").cast("timestamp").alias("ts"), "message")


def test_queries(log, rows):
    bins = L.error_rate(log).select(F.date_format("bin_start", "HH:mm"), F.date_format("bin_end", "HH:mm"), "errors")
    assert rows(bins) == [("00:00", "00:05", 1), ("00:05", "00:10", 2)]
    losses = [(r["id"], r["loss"]) for r in L.extract_loss(log).collect()]
    assert losses == [(7, None), (6, None), (5, 2.5)]
    since = F.lit("2025-01-01 00:05:00").cast("timestamp")
    assert rows(L.search_log(log, "ERROR", since), "id") == [(2,), (3,)]


def test_error_stream_closes_bins_and_drops_late_rows(spark, tmp_path, rows):
    incoming, folder = str(tmp_path / "in"), str(tmp_path / "s")
    schema = "ts timestamp, message string"

    def arrive(*times):
        data = [(f"2025-01-01 {t}", "ERROR") for t in times]
        df = spark.createDataFrame(data, "t string, message string")
        df.select(F.col("t").cast("timestamp").alias("ts"), "message").write.mode("append").parquet(incoming)
        stream = S.stream_errors(S.follow_table(spark, incoming, schema))
        out = S.append_available(stream, folder)
        return rows(out.select(F.date_format("bin_start", "HH:mm"), "errors"))

    assert arrive("00:01:00", "00:02:00", "00:12:00") == []
    assert arrive("00:03:00", "00:20:00") == [("00:00", 3)]
    assert arrive("00:04:00", "00:40:00") == [("00:00", 3), ("00:10", 1), ("00:20", 1)]


def test_run_state_stream_equals_table(spark, make, tmp_path, rows):
    data = [("a", "train/loss", s, float(s % 7), 0.0, s) for s in range(0, 100, 10)]
    data += [("b", "eval/loss", s, float(100 - s), 0.0, s) for s in range(0, 50, 10)]
    incoming = str(tmp_path / "in")
    base = str(tmp_path / "state")
    for half in (data[:8], data[8:]):
        make(half, METRICS_SCHEMA).write.mode("append").parquet(incoming)
        stream = S.run_state(S.follow_table(spark, incoming, METRICS_SCHEMA, files_per_trigger=1))
        out = S.update_available(stream, S.attempt_folder(spark, base), ["run"])
    assert rows(out, "run", "global_step", "train_loss", "best_metric") == rows(
        S.run_state(make(data, METRICS_SCHEMA)), "run", "global_step", "train_loss", "best_metric"
    )


def test_resume_and_fresh_start(spark, tmp_path):
    incoming, base = str(tmp_path / "in"), str(tmp_path / "state")

    def step(low, high, resume=True):
        if high > low:
            spark.range(low, high).write.mode("append").parquet(incoming)
        folder = S.attempt_folder(spark, base, resume)
        return folder, S.append_available(S.follow_table(spark, incoming, "id bigint"), folder).count()

    assert step(0, 10) == (f"{base}/attempt-1", 10)
    assert step(10, 15) == (f"{base}/attempt-1", 15)
    assert step(15, 15) == (f"{base}/attempt-1", 15)
    assert step(15, 15, resume=False) == (f"{base}/attempt-2", 15)
    assert spark.read.parquet(f"{base}/attempt-1/output").count() == 15
    for n in range(3, 11):
        (tmp_path / "state" / f"attempt-{n}").mkdir()
    assert S.attempt_folder(spark, base) == f"{base}/attempt-10"


def test_console_stream(spark, tmp_path, rows):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.log").write_text("{'loss': 2.5, 'step': 10}\nWaiting\n{'eval_loss': 2.0, 'step': 10}\n")
    stream = S.stream_metrics(S.follow_log(spark, str(incoming)), "value", [])
    out = S.append_available(stream, str(tmp_path / "s"))
    assert rows(out, "step", "tag", "value") == [(10, "eval/loss", 2.0), (10, "train/loss", 2.5)]
