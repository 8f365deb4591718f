import json
import random

from pyspark.sql import functions as F

from tunelake.constants import RECORD_FIELDS
from tunelake.functions.strict_json import (
    check_record_schema,
    dumps_record,
    extract_json,
    is_json,
    parse_or_error,
    with_strict_object,
)

VALUES = [
    None, "", "plain", 'say "hi"', "back\\slash", "line\nbreak\ttab\rcr", "a/b", "é ü 漢字 😀",
    '","stage":"x', '{"cancer_type":', ',"stage":', "\\u000B", "\u000b\u001f\u000e", "\\\u000b",
    "\\\\u001F\u001f", "\u007f ", "null", "trailing\\", "\b\f", "$1 \\1", "\u001fA\\u001F",
]

TEXTS = [
    '{"a": "1", "b": null}', "", " ", "{bad", "[1]", '{"a": "x"} trailing', '{"a":"1"}],[{"a":"2"}',
    "{'a': '1'}", "1", '{"a": "1"},{"a": "2"}', '{"a": "1"},', "{}", "null", '{"a": {"z": [1, 2]}}',
    '{"a": 4}', '"text"', '{"a": "1", "a": "2"}', '{"a": "\u0001"}', '{"a": "1"', '{"a": 01}',
    "true", "tru", "nul", '{"a": +1}', '{"a": "1"} // c', '{"a": "1"}], "seal":"x"} junk', "[1", "[[1]",
    "[1]]", '{"a": "x"}}', '{{"a": "x"}', "{a: 1}", '"x', '{"b": ["x"]}', '{"a": tru}', "1 2", "-",
]


def _loads(text):
    try:
        return True, json.loads(text)
    except ValueError:
        return False, None


def test_dumps_equals_python(make):
    random.seed(5)
    fields = RECORD_FIELDS
    records = [
        tuple(random.choice(VALUES) for _ in fields) for _ in range(300)
    ] + [tuple([v] * len(fields)) for v in VALUES]
    schema = "id int, record struct<" + ", ".join(f"{f}: string" for f in fields) + ">"
    df = make(list(enumerate(records)), schema)
    got = dict(df.select("id", dumps_record(F.col("record"))).collect())
    for number, record in enumerate(records):
        assert got[number] == json.dumps(dict(zip(fields, record)), ensure_ascii=False)


def test_dumps_null_record_and_other_fields(make):
    df = make([(1, None), (2, ("x", None))], "id int, r struct<b: string, a: string>")
    got = dict(df.select("id", dumps_record(F.col("r"), ["a", "b"])).collect())
    assert got == {1: "null", 2: '{"a": null, "b": "x"}'}


def test_strict_acceptance_equals_python(make):
    df = make(list(enumerate(TEXTS)), "id int, text string")
    out = with_strict_object(df.withColumn("json", is_json(F.col("text"))), "text", "struct<a: string>", "r")
    for row in out.collect():
        valid, value = _loads(TEXTS[row["id"]])
        assert row["json"] == valid, TEXTS[row["id"]]
        assert (row["r"] is not None) == isinstance(value, dict), TEXTS[row["id"]]
        if isinstance(value, dict) and isinstance(value.get("a"), str):
            assert row["r"]["a"] == value["a"]


def _recover(text):
    """Slice-and-parse, restated."""
    if text is None or "{" not in text:
        return "no_json"
    end = text.rfind("}")
    valid, value = _loads(text[text.find("{"): end + 1])
    if not valid:
        return "malformed"
    return "ok" if value else "empty"


def test_extract_equals_python(make):
    inner = TEXTS + ["} {", "}", "{", 'x {"a": "1"} y', 'x\n{"a":\n"1"}\ny', '{"a":1} x {"b":2}', "{}{}"]
    texts = inner + [f"before {t} after" for t in inner] + [None]
    df = make(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r for r in extract_json(df, "text", ["a", "b"]).collect()}
    for number, text in enumerate(texts):
        assert got[number]["status"] == _recover(text), text
        assert (got[number]["record"] is None) == (got[number]["status"] in ("no_json", "malformed"))


def test_object_with_null_or_foreign_fields_is_not_empty(make):
    df = make([(1, '{"a": null}'), (2, '{"z": 1}'), (3, "{ }")], "id int, text string")
    got = {r["id"]: r["status"] for r in extract_json(df, "text", ["a"]).collect()}
    assert got == {1: "ok", 2: "ok", 3: "empty"}


def test_parse_or_error(make, rows):
    df = make(
        [(1, '{"a": "x"}'), (2, 'Answer: {"a": "x"}'), (3, "[1]"), (4, None), (5, "")],
        "id int, text string",
    )
    out = parse_or_error(df, "text", ["a"])
    failed = "Failed to parse JSON"
    assert rows(out, "id", "predicted.a", "error", "raw") == [
        (1, "x", None, None),
        (2, None, failed, 'Answer: {"a": "x"}'),
        (3, None, None, None),
        (4, None, failed, None),
        (5, None, failed, ""),
    ]


def test_schema_check(make):
    df = make([(1, '{"a": null, "b": "x"}'), (2, '{"c": 1, "a": 2}'), (3, "no")], "id int, t string")
    got = {r["id"]: (r["missing"], r["extra"], r["schema_ok"]) for r in check_record_schema(df, "t", ["a", "b"]).collect()}
    assert got == {1: ([], [], True), 2: (["b"], ["c"], False), 3: (["a", "b"], [], False)}


def test_a_text_of_braces(make, rows):
    import time

    texts = ["{" * 100_000, "}" * 100_000, "}{", '} {"a": "x"} }', '{"a": "x"} {', None, ""]
    df = make(list(enumerate(texts)), "id int, t string")
    start = time.time()
    got = rows(extract_json(df, "t", ["a"]), "id", "status", "record.a")
    assert time.time() - start < 30
    assert got == [(0, "malformed", None), (1, "no_json", None), (2, "malformed", None),
                   (3, "malformed", None), (4, "ok", "x"), (5, "no_json", None), (6, "no_json", None)]
