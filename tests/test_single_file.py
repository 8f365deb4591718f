import csv
import io
import json
import random

import pytest

from tunelake.sources import single_file as W


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(W, "PIECE_BYTES", 300)


def test_csv_is_the_one_of_the_csv_module(spark, tmp_path, small_pieces):
    pick = random.Random(1)
    rows = [(n, pick.choice([None, 0.1, 1e-05, 2.5e16, 3.0, float("nan")]), pick.choice([None, "a,b", 'q"x', "two\nlines", "é", ""]))
            for n in range(3000)]
    df = spark.createDataFrame(rows, "step long, `train/loss` double, note string").repartition(9)
    path = tmp_path / "new" / "metrics.csv"
    W.write_metrics_file(df, f"file://{path}")
    expected = io.StringIO()
    writer = csv.writer(expected)
    writer.writerow(["step", "train/loss", "note"])
    writer.writerows(rows)
    assert path.read_bytes() == expected.getvalue().encode()
    W.write_metrics_file(df.limit(0), str(path))  # replaced whole
    assert path.read_bytes() == b"step,train/loss,note\r\n"
    assert [p.name for p in path.parent.iterdir()] == ["metrics.csv"]


def test_json_is_the_one_of_the_json_module(spark, tmp_path, small_pieces):
    rows = [(n, "é\"\n", {"stage": None if n % 3 else "II", "parts": [1, n]}, n % 2 == 0) for n in range(1500)]
    df = spark.createDataFrame(rows, "id long, input string, expected struct<stage: string, parts: array<long>>, match boolean")
    path = tmp_path / "evaluation_results.json"
    W.write_results_file(df.repartition(5), str(path), ["id"])
    plain = [{"id": i, "input": t, "expected": e, "match": m} for i, t, e, m in rows]
    assert path.read_text() == json.dumps(plain, indent=2)
    W.write_results_file(df.filter("id = 7"), str(path), ["id"])
    assert path.read_text() == json.dumps(plain[7:8], indent=2)
    W.write_results_file(df.limit(0), str(path), ["id"])
    assert path.read_text() == json.dumps([], indent=2)


@pytest.mark.parametrize("bytes_of_task", [7, 333, 5000, 1 << 27])
def test_a_list_is_read_by_many_tasks(spark, tmp_path, small_pieces, bytes_of_task):
    rows = [(n, "é\"\n  },\n[]", {"stage": None if n % 3 else "\n]", "parts": [1, n] if n % 2 else []}, n % 2 == 0, [n])
            for n in range(30 if bytes_of_task < 10 else 700)]
    df = spark.createDataFrame(
        rows, "id long, input string, expected struct<stage: string, parts: array<long>>, match boolean, last array<long>"
    )
    path = str(tmp_path / "evaluation_results.json")
    W.write_results_file(df.repartition(5), path, ["id"])
    given = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in given:
            spark.conf.set(name, bytes_of_task)
        read = W.read_results_file(spark, path, df.schema)
        assert sorted(read.collect()) == sorted(df.collect())
        assert bytes_of_task > 5000 or read.rdd.getNumPartitions() > 10
        W.write_results_file(df.limit(0), path, ["id"])
        assert W.read_results_file(spark, path, df.schema).collect() == []
    finally:
        for name, value in given.items():
            spark.conf.set(name, value)


def test_rows_are_computed_once(spark, tmp_path):
    """A sort by range reads its input twice: what comes before it must not be done twice."""
    done = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            done.add(batch.num_rows)
            yield batch

    df = spark.range(1000, numPartitions=4).mapInArrow(seen, "id long")
    W.write_results_file(df, str(tmp_path / "results.json"), ["id"])
    assert done.value == 1000


def test_stores_without_places_are_refused(spark):
    with pytest.raises(ValueError, match="any place"):
        W.write_metrics_file(spark.range(1).toDF("step"), "s3a://bucket/metrics.csv")
