"""Documents are found and read by tasks, and come out as Spark's reader gives them."""

import json
import os

import pytest

from tunelake.sources import artifacts as A
from tunelake.sources import documents as D
from tunelake.sources import metrics as R

NAME = "state.json"
SCHEMA = "n bigint, s string, inner array<struct<x: double>>"
ODD = {
    "plain": b'{"n": 1, "s": "a\\u00e9\xc3\xa9", "inner": [{"x": 1.5}, {}, {"x": -Infinity}]}',
    "a b/c%20d": b' \n{"n": 2}\n',
    "a#b?c=d;e": b'{"n": 3}',
    "ü\u2003[x]{y}*\"<^`|": b'{"n": 4} and more',
    "=eq/_a=b": b"{'n': 5}",
    "_hidden/x": b'{"n": 6}',
    "x/.hidden": b'{"n": 7}',
    "x/y._COPYING_": b'{"n": 8}',
    "_metadata/z": b'{"n": 9}',
    "empty": b"",
    "blank": b" \r\n\t",
    "vertical": b"\x0b",
    "broken": b'{"n": 10',
    "text": b"nothing",
    "null": b"null",
    "number": b"11",
    "wrong_type": b'{"n": "x", "s": 12.5, "inner": 5}',
    "wrong_inner": b'{"n": 13, "inner": [{"x": "y"}, {"x": 1}]}',
    "list": b'[{"n": 14, "s": "[{"}, {"n": "x", "s": {"k":1.0}},\n {}]',
    "no_elements": b" []",
    "odd_elements": b'[{"n": 15}, 16]',
    "null_elements": b'[{"n": 17}, null]',
    "broken_list": b'[{"n": 18}, {"n": 19]',
    "marked": b'\xef\xbb\xbf{"n": 20}',
    "only_mark": b"\xef\xbb\xbf",
    "utf16": '{"n": 21, "s": "ü"}'.encode("utf-16"),
    "utf16be": '{"n": 22, "s": "ü"}'.encode("utf-16-be"),
    "utf32le": '{"n": 23, "s": "ü"}'.encode("utf-32-le"),
    "invalid": b'{"n": 24, "s": "\xff"}',
    "only_wide_mark": b"\xff\xfe",
    "invalid_start": b'\xff{"n": 24}',
    "zero": b"\x00",
    "invalid_after": b'{"n": 25} \xff',
    "surrogates": b'{"n": 26, "s": "\\ud83d\\ude00"}',
}


@pytest.fixture
def odd(tmp_path):
    base = tmp_path / "in" / "_base"
    for name, raw in ODD.items():
        own = base / name
        own.mkdir(parents=True)
        (own / NAME).write_bytes(raw)
        (own / "other.json").write_text('{"n": -1}')
    (base / os.fsdecode(b"no\xe9text")).mkdir()
    (base / os.fsdecode(b"no\xe9text") / NAME).write_text('{"n": -2}')
    (base / "plain" / os.fsdecode(b"\xff")).write_text("x")
    os.symlink("itself", base / "plain" / "itself")
    os.symlink("nowhere", base / "plain" / "broken")
    os.symlink("../a b", base / "plain" / "link")
    return base


def test_odd_documents(spark, odd, rows, monkeypatch):
    place = str(odd)
    expected = rows(D._read_by_spark(spark, [place], NAME, SCHEMA))
    assert any(row[1:] == (None, None, None) for row in expected) and len(expected) > 25
    assert rows(D.read_documents(spark, place, NAME, SCHEMA)) == expected
    assert rows(D.read_documents(spark, [place, f"file://{place}/", f"{place}/x", f"{place}/plain/{NAME}"], NAME, SCHEMA)) == expected
    pattern = f"{place}/{{a*,list}}"
    some = rows(D._read_by_spark(spark, [pattern], NAME, SCHEMA))
    assert 0 < len(some) < len(expected) and rows(D.read_documents(spark, pattern, NAME, SCHEMA)) == some
    monkeypatch.setattr(D, "LARGE_FILE", 12)  # above it, Spark reads
    assert rows(D.read_documents(spark, place, NAME, SCHEMA)) == expected
    monkeypatch.setattr(D, "_roots", lambda *_: None)  # as for other stores
    assert rows(D.read_documents(spark, place, NAME, SCHEMA)) == expected


def test_no_documents(spark, tmp_path):
    (tmp_path / "other.json").write_text("{}")
    found = D.read_documents(spark, str(tmp_path), NAME, SCHEMA)
    assert found.columns == ["_file", "n", "s", "inner"] and found.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        D.read_documents(spark, str(tmp_path / "missing"), NAME, SCHEMA)


def test_names_of_trainer_states_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """Before, every state file went through Spark's listing."""
    monkeypatch.setattr(A, "LARGE_FOLDER", 100)
    monkeypatch.setattr(D, "TASK_FILES", 64)
    for number in range(600):
        own = tmp_path / f"r{number % 2}" / f"checkpoint-{number}"
        own.mkdir(parents=True)
        state = {"global_step": number, "log_history": [{"step": number, "loss": 0.5}, {"step": -1, "loss": 0.25}]}
        (own / "trainer_state.json").write_text(json.dumps(state))
    listed = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = listed.getCount()
    headers, found = R.read_trainer_state(spark, str(tmp_path))
    assert headers.count() == 600
    # Of a run's first checkpoint the whole history is taken, of others the steps after the one before.
    assert sorted(r["step"] for r in found.collect()) == [-1, -1, *range(600)]
    assert listed.getCount() - before < 600
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_batches_of_texts(tmp_path, monkeypatch):
    monkeypatch.setattr(D, "BATCH_BYTES", 30)
    monkeypatch.setattr(D, "BATCH_FILES", 4)
    for number in range(10):
        (tmp_path / f"f{number}").write_text("[]" if number else " " * 40 + "[]")
    given = A.pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}/f{number}" for number in range(10)]})
    assert [batch.num_rows for batch in D._texts([given])] == [1, 4, 4, 1]
    gone = A.pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}/gone"]})
    assert list(D._texts([gone], missing_ok=True)) == []
    with pytest.raises(FileNotFoundError):
        list(D._texts([gone]))


def test_folders_of_any_name_are_listed(spark, tmp_path):
    names = ["a b", "c%20d", "e#f", "g?h", "ü[x]"]
    for name in names:
        (tmp_path / name).mkdir()
        (tmp_path / name / "x").write_text("1")
    listed = A.list_artifacts(spark, str(tmp_path))
    assert sorted(r["path"] for r in listed.collect()) == sorted(f"file:{tmp_path}/{name}/x" for name in names)
    assert A.list_artifacts(spark, f"file://{tmp_path}/a%20b").first()["path"] == f"file://{tmp_path}/a%20b/x"
