import json
import random

from tunelake.operators.evaluation import same_object, score_predictions
from pyspark.sql import functions as F


def made(pick, depth=0):
    kind = pick.randrange(9 if depth < 3 else 6)
    if kind < 6:
        return pick.choice(['"a"', '"b"', "1", "1.0", "true", "false", "null", "0", "-0.0", "1e2", "100", '"é"', '"\\u00e9"', "2.5", '"true"', "NaN"])
    if kind == 6:
        return "[" + ", ".join(made(pick, depth + 1) for _ in range(pick.randrange(3))) + "]"
    return an_object(pick, depth + 1)


def an_object(pick, depth=0):
    members = [f'"{pick.choice("xyz")}": {made(pick, depth)}' for _ in range(pick.randrange(4))]
    return "{" + ", ".join(members) + "}"


def test_random_pairs_as_python_has_them(make, rows):
    pick = random.Random(9)
    pairs = []
    for n in range(3000):
        left = an_object(pick)
        right = an_object(pick) if n % 3 else left.replace("1.0", "1").replace("true", "1")
        pairs.append((n, left, right))
    pairs += [(5000, '{"a": {"b": 1, "b": 2}}', '{"a": {"b": 2.0}}'), (5001, "[{}]", "[{}]"), (5002, None, "{}"), (5003, '{"a": {}} x', '{"a": {}}')]
    pairs += [(6000, "{" + ", ".join(f'"k{i % 700}": {i}' for i in range(3000)) + "}", "{" + ", ".join(f'"k{i % 700}": {i}' for i in range(3000)) + "}")]

    def expected(left, right):
        try:
            a, b = json.loads(left), json.loads(right)
        except (TypeError, ValueError):
            return False
        return isinstance(a, dict) and isinstance(b, dict) and a == b

    df = make(pairs, "id int, l string, r string")
    got = dict(rows(df.select("id", same_object(F.col("l"), F.col("r")))))
    wrong = [(n, l, r, got[n]) for n, l, r in pairs if got[n] != expected(l, r)]
    assert not wrong, wrong[:5]
    assert sum(got.values()) > 500


def test_scores_of_nested_records(make, rows):
    pairs = [(1, '{"a": {"b": [1, {"c": true}]}}', '{"a": {"b": [1.0, {"c": 1}]}}'), (2, '{"a": {"b": 1}}', '{"a": {"b": "1"}}')]
    df = make(pairs, "id int, expected_json string, predicted_json string")
    scored = score_predictions(df.drop("predicted_json"), df.drop("expected_json"), ["id"], ["a"])
    assert rows(scored, "id", "match") == [(1, True), (2, False)]
