from datetime import datetime

from pyspark.sql import functions as F

from tunelake import constants as K
from tunelake.functions import paths as P
from tunelake.functions.templates import chat_prompt, inference_prompt, training_text
from tunelake.functions.text import after_last_marker, strip, strip_prompt

TEXTS = ["", " ", "a", " a b ", "\n\t x \r\n", " x ", "\x1c\x1fy\x85", "​z", "é 　"]


def test_strip_equals_python(make):
    df = make(list(enumerate(TEXTS)), "id int, t string")
    got = dict(df.select("id", strip(F.col("t"))).collect())
    assert got == {i: t.strip() for i, t in enumerate(TEXTS)}


def test_strip_prompt_is_positional(make):
    pairs = [("abc", "abc  def "), ("xyz", "abcd"), ("long prompt", "short"), ("é😀", "é😀 ok"), ("", " a ")]
    df = make([(i, p, f) for i, (p, f) in enumerate(pairs)], "id int, p string, f string")
    got = dict(df.select("id", strip_prompt(F.col("f"), F.col("p"))).collect())
    assert got == {i: f[len(p):].strip() for i, (p, f) in enumerate(pairs)}


def test_after_last_marker(make):
    texts = ["none ", "a<m>b", "a<m>b<m> c\n", "<m>"]
    df = make(list(enumerate(texts)), "id int, t string")
    got = dict(df.select("id", after_last_marker(F.col("t"), "<m>")).collect())
    assert got == {i: t.split("<m>")[-1].strip() for i, t in enumerate(texts)}


def test_templates(make):
    df = make([("do", "text", "{}"), (None, None, "null")], "i string, t string, o string")
    chat, training, plain = [], [], []
    for row in df.select(
        chat_prompt(F.col("i"), F.col("t")),
        training_text(F.col("i"), F.col("t"), F.col("o")),
        inference_prompt(F.col("t")),
    ).collect():
        chat.append(row[0]), training.append(row[1]), plain.append(row[2])

    def expected(instruction, text):
        return (
            "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n" + K.SYSTEM_PROMPT
            + "<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n"
            + f"{instruction}\n\nText: {text}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
        )

    assert sorted(chat) == sorted([expected("do", "text"), expected(None, None)])
    assert sorted(training) == sorted(
        [expected("do", "text") + "{}<|eot_id|>", expected(None, None) + "null<|eot_id|>"]
    )
    assert "Extract all cancer-related entities from the text.\n\ntext\n\nOutput (JSON format):\n" in plain


def test_run_names(make):
    names = [
        "20251110_120000", "20251310_120000", "20251110-120000", "20251110_12000", "2025111_0120000",
        "20250229_000000", "20240229_235959", "abcdefgh_ijklmn", "20251110_250000",
    ]
    df = make([(n,) for n in names], "n string")
    got = {
        n: t for n, t in df.select("n", F.date_format(P.run_started_at(F.col("n")), "yyyyMMdd_HHmmss")).collect()
    }

    def valid(name):
        try:
            return len(name) == 15 and name[8] == "_" and bool(datetime.strptime(name, "%Y%m%d_%H%M%S"))
        except ValueError:
            return False

    assert got == {n: (n if valid(n) else None) for n in names}


def test_paths(make):
    cases = {
        "out/checkpoint-200/trainer_state.json": "checkpoint",
        "out/backup_20250101_000000/checkpoint-100/x": "backup",
        "out/final_model/adapter.bin": "final_model",
        "out/final_model": "final_model",
        "out/final_model_old/x": "other",
        "checkpoint-7": "checkpoint",
        "out/my-checkpoint-7/x": "other",
        "logs/a": "other",
    }
    df = make([(p,) for p in cases], "p string")
    assert dict(df.select("p", P.artifact_kind(F.col("p"))).collect()) == cases

    df = make([("base/a/b",), ("base/base/c",), ("base/",), ("base",), ("other/a",)], "p string")
    got = dict(df.select("p", P.relative_key(F.col("p"), "base")).collect())
    assert got == {"base/a/b": "a/b", "base/base/c": "base/c", "base/": "", "base": "", "other/a": None}

    df = make([("a\\b",)], "p string")
    assert df.select(P.artifact_key("pre/", F.col("p"))).first()[0] == "pre/a/b"
    df = make([("c-9/",), ("c-10",), ("c-x",), ("none",)], "p string")
    got = dict(df.select("p", P.checkpoint_step(F.col("p"))).collect())
    assert got == {"c-9/": 9, "c-10": 10, "c-x": None, "none": None}
