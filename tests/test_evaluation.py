import json

import pytest
from pyspark.sql import functions as F

from tunelake.operators import evaluation as E
from tunelake.operators.inference import batch_infer, run_sample_grid
from tunelake.plans.evaluation import evaluate, recover_records

FIELDS = ["a", "b"]
EXPECTED = {"a": "x", "b": None}
PREDICTED = {
    1: ('{"a": "x", "b": null}', True),
    2: ('{"b": null, "a": "x"}', True),
    3: ('{"a": "y", "b": null}', False),
    4: ('{"a": "x"}', False),
    5: ('{"a": "x", "b": null, "c": 1}', False),
    6: ("not json", False),
    7: (None, False),
    8: ("[]", False),
    9: (' {"a":"x","b":null}\n', True),
}


@pytest.fixture
def scored(make):
    expected = make([(i, json.dumps(EXPECTED)) for i in [*PREDICTED, 10]], "id int, expected_json string")
    predicted = make([(i, p) for i, (p, _) in PREDICTED.items()], "id int, predicted_json string")
    return E.score_predictions(expected, predicted, ["id"], FIELDS)


def test_scores(scored, rows):
    assert {r["id"]: r["match"] for r in scored.collect()} == {
        **{i: m for i, (_, m) in PREDICTED.items()}, 10: False
    }
    row = E.exact_match_accuracy(scored).first()
    assert tuple(row) == (10, 3, 30.0)
    assert rows(E.field_accuracy(scored, FIELDS)) == [("a", 50.0), ("b", 60.0)]


def test_no_samples(scored):
    row = E.exact_match_accuracy(scored.filter("false")).first()
    assert tuple(row) == (0, 0, None)


def test_pairs_of_a_small_file_are_parsed_by_many_tasks(spark, tmp_path):
    """What one task scans, and a broadcast joins, is parsed by more."""
    text = "concat('{\"a\": \"', sha2(string(id), 512), sha2(string(-id), 512), '\", \"b\": null}') as json"
    side = spark.range(12_000, numPartitions=1).selectExpr("id", text)
    side.write.parquet(f"{tmp_path}/side")
    side = spark.read.parquet(f"{tmp_path}/side")
    scored = E.score_predictions(
        side.withColumnRenamed("json", "expected_json"), side.withColumnRenamed("json", "predicted_json"), ["id"], FIELDS
    )
    tasks = scored.select("match", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) > 1 and all(t.match for t in tasks)


def test_numbers_by_value(spark):
    given = {"a": 1.0, "b": "1.0", "c": 'x\\".0', "d": -2.0, "e": 1.05, "f": [3.0, "4.0"], "g": None, "h": ".0"}
    df = spark.createDataFrame([(json.dumps(given),)], "t string")
    found = df.select(E.object_members(F.col("t")).alias("m")).first()["m"]
    assert {m["key"]: m["value"] for m in found} == {
        "a": "1", "b": '"1.0"', "c": json.dumps(given["c"]), "d": "-2", "e": "1.05", "f": '[3,"4.0"]', "g": "null", "h": '".0"'}


def test_open_records(make):
    pairs = [('{"a":1,"z":{"k":[1]}}', '{"z":{"k":[1]},"a":1}', True), ('{"a":1}', '{"a":2}', False), ("x", "x", False)]
    df = make([(i, l, r) for i, (l, r, _) in enumerate(pairs)], "id int, l string, r string")
    got = dict(df.select("id", E.same_object(F.col("l"), F.col("r"))).collect())
    assert got == {i: p[2] for i, p in enumerate(pairs)}


def test_parse_rate(make, rows):
    df = make([("ok",), ("ok",), ("empty",), ("malformed",)], "status string")
    assert rows(E.parse_rate(df)) == [
        ("empty", 1, 25.0), ("malformed", 1, 25.0), ("no_json", 0, 0.0), ("ok", 2, 50.0)
    ]


def test_compare_runs(make, rows):
    out = make(
        [("p", 1, "x", None), ("q", 1, "x", "n"), ("p", 2, "s", "t"), ("q", 2, "s", "t"), ("p", 3, "u", None), ("z", 1, "?", "?")],
        "run string, id int, a string, b string",
    )
    assert rows(E.compare_runs(out, "p", "q", ["id"], FIELDS)) == [(1, "b", None, "n"), (3, "a", "u", None)]


def test_grid(make, rows):
    grid = run_sample_grid(make([(1,), (2,)], "id int"), ["p", "q"])
    assert rows(grid, "id", "run") == [(1, "p"), (1, "q"), (2, "p"), (2, "q")]


def test_model_is_made_once_for_each_process(spark, make, tmp_path):
    made = str(tmp_path / "made")

    def factory():
        import os

        with open(made, "a") as log:
            log.write(f"{os.getpid()}\n")
        return lambda prompts, params: [f"{p}|{len(prompts)}|{params['top_p']}" for p in prompts]

    df = make([(i, f"p{i}") for i in range(50)], "id int, prompt string")
    out = batch_infer(df, factory, batch_size=4, partitions=6, params={"top_p": 0.5}).collect()
    assert {r["id"] for r in out} == set(range(50))
    for row in out:
        text, size, top_p = row["full_output"].split("|")
        assert text == row["prompt"] and 1 <= int(size) <= 4 and top_p == "0.5"
    processes = open(made).read().split()
    assert len(processes) == len(set(processes))


def test_two_models_in_one_session(make):
    def model(word):
        return lambda: lambda prompts, params: [word for _ in prompts]

    df = make([(1, "p", 2.5)], "id int, prompt string, more double")
    for word in ("first", "second", "first"):
        row = batch_infer(df, model(word)).first()
        assert (row["full_output"], row["more"]) == (word, 2.5)


def test_a_model_for_each_run(make):
    def model(run):
        return lambda prompts, params: [f"{run}:{p}" for p in prompts]

    grid = run_sample_grid(make([(i, f"p{i}") for i in range(20)], "id int, prompt string"), ["x", "y", "z"])
    got = batch_infer(grid, model, partitions=5, run_column="run").collect()
    assert len(got) == 60 and all(r["full_output"] == f"{r['run']}:{r['prompt']}" for r in got)


def test_model_must_answer_every_prompt(make):
    def short_factory():
        return lambda prompts, params: []

    df = make([(1, "p")], "id int, prompt string")
    with pytest.raises(Exception, match="one output for each prompt"):
        batch_infer(df, short_factory).collect()
    with pytest.raises(ValueError):
        batch_infer(df, short_factory, batch_size=0)


def test_flows(make, rows):
    def factory():
        def run(prompts, params):
            return [p + ('{"a": "x", "b": null}' if "good" in p else "no idea") for p in prompts]

        return run

    texts = make([(1, "good"), (2, "bad")], "id int, text string")
    out = recover_records(texts, factory, fields=FIELDS)
    assert rows(out, "id", "status", "record.a") == [(1, "ok", "x"), (2, "no_json", None)]

    samples = make(
        [(1, "do", "good", json.dumps(EXPECTED)), (2, "do", "bad", json.dumps(EXPECTED))],
        "id int, instruction string, input string, expected_json string",
    )
    result = evaluate(samples, factory, fields=FIELDS)
    assert tuple(result["accuracy"].first()) == (2, 1, 50.0)
    assert rows(result["scored"], "id", "match", "raw") == [(1, True, None), (2, False, "no idea")]


def test_match_as_python_compares(make):
    texts = ['{"a":1}', '{"a":1.0}', '{"a":1e0}', '{"a":"1"}', '{"a":"1.0"}', '{"a":null}', "{}", '{"b":1}',
             '{"a":"y","a":"x"}', '{"a":"x"}', '{"a":{"z":[1,2.50],"b":null}}', '{"a":{"b":null,"z":[1.0,2.5]}}',
             '{"a":"\\u0041 \\"2.0\\""}', '{"a":"A \\"2.0\\""}', '{"a":"true"}', '{"b":2,"a":1}',
             '{"a":1,"b":2}', '{"a":100000}', '{"a":1E5}', '{"a":-0.0}', '{"a":0}', '{"a":[]}']
    pairs = [(x, y) for x in texts for y in texts]
    df = make(pairs, "x string, y string")
    got = df.select("x", "y", E.same_object(F.col("x"), F.col("y")).alias("same")).collect()
    assert all(r["same"] == (json.loads(r["x"]) == json.loads(r["y"])) for r in got)
    wrong = make([("nope", "nope"), (None, "{}"), ("[1]", "[1]")], "x string, y string")
    assert not any(r[0] for r in wrong.select(E.same_object(F.col("x"), F.col("y"))).collect())


@pytest.fixture
def spread(spark):
    """Shuffled rows stay where they were dealt, however few they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pairs_of_one_key_are_compared_by_many_tasks(spark, make, spread):
    left = make([(1, f'{{"a": "{i}"}}') for i in range(20)], "id int, expected_json string").coalesce(1)
    right = make([(1, f'{{"a": "{i}"}}') for i in range(20)], "id int, predicted_json string").coalesce(1)
    dealt = E.dealt_out(left.join(right, "id"))
    task, same = F.spark_partition_id(), E.same_object(F.col("expected_json"), F.col("predicted_json"))
    got = dealt.select(task.alias("task"), same.alias("same")).collect()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(got) == 400 and sum(r.same for r in got) == 20
    assert len({r.task for r in got}) > min(tasks, 400) // 2 >= 1


def test_open_match_deals_its_pairs_before_it_parses_them(spark):
    from __spark_entry__ import SMOKE_DIR, queries

    plan = queries()["open_match"](spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("RebalancePartitions") < plan.index("Join")


def test_null_odd_and_repeated_pairs_stay(make, spread):
    texts = [(1, None, '{"a": 1}'), (1, None, '{"a": 1}'), (None, '{"a": 1}', '{"a": 1.0}'), (2, "", ""), (2, None, None),
             (3, '{"a": {"b": true}}', '{"a": {"b": 1}}'), (3, '{"a": {"b": true}}', '{"a": {"b": 1}}'), (4, "x", "{}"), (4, "{}", "{}")]
    given = make(texts, "id int, l string, r string")
    got = E.dealt_out(given).select("id", "l", "r", E.same_object(F.col("l"), F.col("r")).alias("same")).collect()
    want = [(*t, False) for t in texts[:2]] + [(*texts[2], True)] + [(*t, False) for t in texts[3:5]]
    want += [(*t, True) for t in texts[5:7]] + [(*texts[7], False), (*texts[8], True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert E.dealt_out(given.limit(0)).count() == 0
