import pytest
from pyspark.sql import functions as F

from tunelake.operators import catalog as C
from tunelake.sources import artifacts as A
from tunelake.sources.sinks import write_eval_results, write_run_partitioned, write_runs_partitioned

PATHS = [
    "m/20251110_120000/final_model/adapter_config.json",
    "m/20251110_120000/final_model/adapter_model.safetensors",
    "m/20251110_120000/logs/events.1",
    "m/20251111_022951/final_model/adapter_config.json",
    "m/20251111_022951/checkpoint-200/trainer_state.json",
    "m/20251111_022951/checkpoint-1000/trainer_state.json",
    "m/20251111_022951/checkpoint-1000/optimizer.pt",
    "m/20251112_000000/logs/",
    "m/20251301_000000/logs/events.1",
    "m/readme.md",
    "other/20251115_000000/logs/events.1",
]


@pytest.fixture
def artifacts(make):
    return make([(p, i * 1048576) for i, p in enumerate(PATHS)], "path string, length bigint")


def test_runs(artifacts, rows):
    runs = A.list_runs(artifacts, "m")
    assert rows(runs, "run", "prefix", "logs_prefix", "formatted_date") == [
        ("20251110_120000", "m/20251110_120000", "m/20251110_120000/logs/", "2025-11-10 12:00:00"),
        ("20251111_022951", "m/20251111_022951", "m/20251111_022951/logs/", "2025-11-11 02:29:51"),
        ("20251112_000000", "m/20251112_000000", "m/20251112_000000/logs/", "2025-11-12 00:00:00"),
    ]
    inside = A.with_run(artifacts, "m/")
    assert rows(C.runs_with_logs(runs, inside), "run") == [("20251110_120000",), ("20251112_000000",)]
    assert C.latest_run(runs).first()["run"] == "20251112_000000"
    assert C.select_run(runs, "20251110_120000").count() == 1
    assert C.select_run(runs).first()["run"] == "20251112_000000"
    with pytest.raises(LookupError):
        C.select_run(runs, "nope")
    assert rows(C.missing_required_files(runs, inside)) == [
        ("20251111_022951", "adapter_model.safetensors"),
        ("20251112_000000", "adapter_config.json"),
        ("20251112_000000", "adapter_model.safetensors"),
    ]


def test_checkpoints(artifacts, rows):
    saved = C.list_checkpoints(A.with_run(artifacts, "m"))
    assert rows(saved) == [
        ("20251111_022951", 1000, "checkpoint-1000"), ("20251111_022951", 200, "checkpoint-200")
    ]
    assert rows(C.latest_checkpoint(saved), "step") == [(1000,)]


def test_best_checkpoint_was_saved(make, rows):
    m = make(
        [("r", "eval/loss", s, v, 0.0, i) for i, (s, v) in enumerate(
            [(200, 0.7), (400, 0.66), (600, 0.66), (1100, 0.65), (1200, None)])],
        "run string, tag string, step bigint, value double, wall_time double, ord bigint",
    )
    saved = make([("r", s, f"checkpoint-{s}") for s in range(200, 1400, 200)], "run string, step bigint, path string")
    best = C.best_checkpoint(m, saved)
    assert rows(best) == [("r", 400, 0.66, "checkpoint-400")]
    plan = C.retention_plan(saved, best)
    assert rows(plan.filter("keep"), "step") == [(1000,), (1200,), (400,), (800,)]
    assert C.retention_plan(saved, keep=1).filter("keep").count() == 1
    text = C.retention_plan(saved)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_summary_and_head(make, rows):
    files = make([("r", f"p{i:03d}", 1048576 + i) for i in range(25)] + [("s", "x", 524288)], "run string, path string, length bigint")
    assert rows(C.artifact_summary(files, ["run"]), "run", "objects", "megabytes", "more") == [
        ("r", 25, 25.0, 15), ("s", 1, 0.5, 0)
    ]
    assert rows(C.artifact_head(files, ["run"]).filter("run = 'r'"), "path") == [(f"p{i:03d}",) for i in range(10)]
    assert rows(C.head_by_key(files, ["path"], 2), "path") == [("p000",), ("p001",)]


def test_existence(artifacts):
    assert C.artifacts_exist(artifacts, "m/20251110_120000/final_model/")
    assert not C.artifacts_exist(artifacts, "m/none/")


def test_listing_and_manifest(spark, tmp_path, rows):
    for name in ("final_model/a.bin", "final_model/.git/b", "c.txt", "_x.json", "skip/.hid/d"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("x" * 7)
    files = A.list_artifacts(spark, str(tmp_path))
    root = files.select(F.regexp_extract("path", "(.*)/c.txt", 1).alias("r")).filter("r <> ''").first()["r"]
    out = A.artifact_manifest(files, root, "models/x", exclude=[".git", "skip"])
    assert rows(out, "key", "length") == [
        ("models/x/_x.json", 7), ("models/x/c.txt", 7), ("models/x/final_model/a.bin", 7)
    ]
    assert files.count() == 5 and files.filter("modificationTime is null").isEmpty()


def test_cleanup(artifacts, rows):
    plan = C.cleanup_plan(artifacts)
    assert rows(plan.groupBy("kind", "action").count()) == [
        ("checkpoint", "delete", 3), ("final_model", "delete", 3), ("other", "keep", 5)
    ]
    assert C.cleanup_plan(artifacts, True).filter("action = 'delete'").count() == 3


def test_run_is_never_overwritten(make, spark, tmp_path):
    df = make([(1,)], "x int")
    base = str(tmp_path / "out")
    write_run_partitioned(df, base, "20251110_120000")
    write_run_partitioned(df, base, "20251111_022951")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_run_partitioned(df, base, "20251110_120000")
    assert spark.read.parquet(base).select("run").distinct().count() == 2


def test_runs_are_never_overwritten(make, spark, tmp_path):
    base = str(tmp_path / "out")
    write_runs_partitioned(make([("a", 1), ("b", 2)], "run string, x int"), base)
    write_runs_partitioned(make([("c", 3)], "run string, x int"), base)
    with pytest.raises(FileExistsError):
        write_runs_partitioned(make([("d", 4), ("b", 2)], "run string, x int"), base)
    assert sorted(r["run"] for r in spark.read.parquet(base).collect()) == ["a", "b", "c"]


def test_results_keep_nulls(make, tmp_path):
    path = tmp_path / "r"
    write_eval_results(make([("a", None)], "id string, predicted string"), str(path))
    text = "".join(p.read_text() for p in path.glob("part-*"))
    assert text == '{"id":"a","predicted":null}\n'
