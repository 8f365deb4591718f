import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tunelake.constants import RECORD_FIELDS
from tunelake.functions.templates import format_training_text
from tunelake.operators import dataset as D
from tunelake.operators import tokens as T
from tunelake.plans.training import prepare_training_table, training_batches
from tunelake.sources.examples import load_splits, parse_example_lines, read_examples, store_examples

RECORD = {f: None for f in RECORD_FIELDS} | {"cancer_type": "melanoma “x”", "stage": "IV"}
GOOD = [
    json.dumps({"instruction": "do", "input": "text é", "output": RECORD}, ensure_ascii=False),
    "  " + json.dumps({"output": RECORD, "input": None, "instruction": "do", "more": 1}) + " \t",
    json.dumps({"instruction": "do", "input": "no answer", "output": None}),
]
BAD = {
    "": "blank", "   ": "blank", "{bad": "malformed", GOOD[0] + " x": "malformed",
    GOOD[0] + GOOD[2]: "malformed", "[1]": "not_object", "7": "not_object", "null": "not_object",
    '{"instruction": "i", "input": "t"}': "missing_key", "{}": "missing_key",
    '{"instruction": "i", "input": "t", "output": "text"}': "output_not_object",
    '{"instruction": "i", "input": "t", "output": [1]}': "output_not_object",
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(GOOD[:1] + list(BAD)) + "\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text("\n".join(GOOD[1:]) + "\n", encoding="utf-8")
    return str(tmp_path)


def test_good_and_rejected(spark, folder, rows):
    good, rejects = read_examples(spark, folder)
    assert rows(good, "instruction", "input", "output.cancer_type", "output.stage") == sorted(
        [("do", "text é", "melanoma “x”", "IV"), ("do", None, "melanoma “x”", "IV"), ("do", "no answer", None, None)],
        key=repr,
    )
    assert {r["value"]: r["reason"] for r in rejects.collect()} == BAD
    assert {r["file_path"].rsplit("/", 1)[1] for r in rejects.collect()} == {"a.jsonl"}


def test_a_line_is_parsed_once(spark, folder):
    good, _ = read_examples(spark, folder)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(v,ArrayType(StructType") == 1


def test_counts_are_observed(spark, folder):
    seen = Observation("counts")
    good, _ = read_examples(spark, folder)
    good.observe(seen, F.count(F.lit(1)).alias("good")).collect()
    assert seen.get["good"] == 3


def test_fail_mode(spark, folder, tmp_path):
    good, _ = read_examples(spark, folder, mode="fail")
    with pytest.raises(Exception, match="unusable example"):
        good.collect()
    lone = tmp_path / "only"
    lone.mkdir()
    (lone / "c.jsonl").write_text(GOOD[0] + "\n{bad\n\n", encoding="utf-8")
    good, rejects = read_examples(spark, str(lone), mode="fail")
    assert good.count() == 1 and rejects.count() == 2
    with pytest.raises(ValueError):
        read_examples(spark, folder, mode="other")


def test_stored_once(make, tmp_path):
    lines = make([(t,) for t in GOOD + list(BAD)], "value string")
    good, rejects = store_examples(parse_example_lines(lines), str(tmp_path / "s"))
    assert good.columns == ["instruction", "input", "output"] and good.count() == len(GOOD)
    assert {r["value"]: r["reason"] for r in rejects.collect()} == BAD
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan and "value" not in plan.split("ReadSchema")[1]


def test_training_text(spark, folder):
    good, _ = read_examples(spark, folder)
    texts = [r["text"] for r in format_training_text(good).collect()]
    assert any(
        t.endswith(f"Text: text é<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
                   f"{json.dumps(RECORD, ensure_ascii=False)}<|eot_id|>")
        for t in texts
    )
    assert any("Text: None<|eot_id|>" in t for t in texts)
    assert any(t.endswith("assistant<|end_header_id|>\n\nnull<|eot_id|>") for t in texts)


def test_training_table(spark, folder):
    tokenised, rejects = prepare_training_table(
        spark, {"train": folder + "/a.jsonl", "validation": folder + "/b.jsonl"}, max_len=5
    )
    counts = {r["split"]: r["examples"] for r in D.count_examples(tokenised).collect()}
    assert counts == {"train": 1, "validation": 2}
    assert rejects.filter("split = 'train'").count() == len(BAD)
    assert all(len(r["input_ids"]) == 5 and r["was_truncated"] for r in tokenised.collect())


def test_splits_need_input():
    with pytest.raises(ValueError):
        load_splits({})


def test_profile(make):
    out = parse_example_lines(make([(g,) for g in GOOD], "value string"))
    row = D.profile_dataset(out.withColumn("n_tokens", F.lit(3)), max_len=2).first()
    assert (row["examples"], row["mean_tokens"], row["max_tokens"], row["over_limit"]) == (3, 3.0, 3, 3)
    assert row["stage_null_share"] == pytest.approx(1 / 3)


def _pad(ids, width, pad):
    return ids + [pad] * (width - len(ids))


@pytest.mark.parametrize("by_length", [False, True])
def test_collate_equals_python(make, by_length):
    lists = [list(range(1, 1 + (7 * i) % 11)) for i in range(23)]
    data = make(
        [(i, ids, [1] * len(ids), len(ids)) for i, ids in enumerate(lists)],
        "id int, input_ids array<int>, attention_mask array<int>, length int",
    )
    got = {r["id"]: r for r in T.collate(
        data, "id", pad_id=2, sort_by_length=by_length
    ).collect()}
    assert len(got) == 23
    order = sorted(range(23), key=lambda i: (len(lists[i]), i)) if by_length else list(range(23))
    for place, i in enumerate(order):
        batch = order[place // 4 * 4: place // 4 * 4 + 4]
        width = max(len(lists[b]) for b in batch)
        ids = _pad(lists[i], width, 2)
        assert got[i]["batch_id"] == place // 4
        assert got[i]["input_ids"] == ids
        assert got[i]["attention_mask"] == _pad([1] * len(lists[i]), width, 0)
        assert got[i]["labels"] == [-100 if t == 2 else t for t in ids]


def test_batches_keep_splits_and_rows(make):
    data = make([(i // 3, "a" if i % 2 else "b", [i] * (i % 5), i % 5) for i in range(30)],
                "id int, split string, input_ids array<int>, length int")
    got = T.collate(data, "id", pad_id=0, group=["split"]).collect()
    assert len(got) == 30  # rows that share a key do not multiply
    members = {}
    for r in got:
        members.setdefault((r["split"], r["batch_id"]), []).append(r)
    assert sorted(len(m) for m in members.values()) == [3, 3, 4, 4, 4, 4, 4, 4]
    for m in members.values():
        assert {r["batch_length"] for r in m} == {max(r["length"] for r in m)}


def test_examples_to_batches(spark, tmp_path):
    for split, count in (("train", 9), ("validation", 3)):
        lines = [json.dumps({"instruction": "i", "input": "x" * n, "output": {}}) for n in range(count)]
        (tmp_path / f"{split}.jsonl").write_text("\n".join([*lines, "broken {"]))
    tokens, rejects = prepare_training_table(
        spark, {s: str(tmp_path / f"{s}.jsonl") for s in ("train", "validation")},
        T.character_ids(F.col("text")),
    )
    assert rejects.count() == 2
    got = training_batches(tokens, pad_id=0).collect()
    assert sorted((r["split"], r["batch_id"]) for r in got) == sorted(
        [("train", i // 4) for i in range(9)] + [("validation", 0)] * 3
    )
    assert len({(r["split"], r["example_id"]) for r in got}) == 12


def test_two_encoders_in_one_session(make):
    def encoder(number):
        return lambda: lambda texts: [[number] for _ in texts]

    df = make([(1, "a")], "id int, text string")
    for number in (1, 2, 1):
        out = T.tokenize(df, T.encoder_ids(F.col("text"), encoder(number)))
        assert out.first()["input_ids"] == [number]


def test_tokenizers(make):
    df = make([(1, "one  two\nthree"), (2, " "), (3, "é😀")], "id int, text string")
    words = {r["id"]: r for r in T.tokenize(df, max_len=2).collect()}
    assert [words[i]["n_tokens"] for i in (1, 2, 3)] == [3, 0, 1]
    assert words[1]["was_truncated"] and len(words[1]["input_ids"]) == 2
    assert words[1]["attention_mask"] == [1, 1] and words[2]["attention_mask"] == []
    characters = {r["id"]: r["input_ids"] for r in T.tokenize(df, T.character_ids(F.col("text"))).collect()}
    assert characters == {1: [ord(c) for c in "one  two\nthree"], 2: [32], 3: [ord("é"), ord("😀")]}


def test_user_tokenizer(make):
    def _byte_encoder():
        return lambda texts: [list(t.encode()) for t in texts]

    df = make([(1, "ab"), (2, "é")], "id int, text string")
    out = T.tokenize(df, T.encoder_ids(F.col("text"), _byte_encoder))
    assert {r["id"]: r["input_ids"] for r in out.collect()} == {1: [97, 98], 2: list("é".encode())}


def test_tokenizer_is_made_once_for_each_process(spark, tmp_path):
    made = str(tmp_path / "made")

    def factory():
        import os

        with open(made, "a") as log:
            log.write(f"{os.getpid()}\n")
        return lambda texts: [[len(t)] for t in texts]

    df = spark.range(0, 40, 1, 8).select("id", F.col("id").cast("string").alias("text"))
    ids = T.encoder_ids(F.col("text"), factory)
    for _ in range(2):
        out = T.tokenize(df, ids)
        assert sorted(r["input_ids"][0] for r in out.collect()) == [1] * 10 + [2] * 30
    processes = open(made).read().split()
    assert len(processes) == len(set(processes)) < 16


def test_public_subword_tokenizer(make):
    tokenizers = pytest.importorskip("tokenizers")
    file = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")

    def factory():
        import tokenizers

        loaded = tokenizers.Tokenizer.from_file(file)
        return lambda texts: [e.ids for e in loaded.encode_batch(texts)]

    df = make([(1, "low newer"), (2, "lowest")], "id int, text string")
    got = {r["id"]: r["input_ids"] for r in T.tokenize(df, T.encoder_ids(F.col("text"), factory)).collect()}
    model = tokenizers.Tokenizer.from_file(file)
    assert got == {1: model.encode("low newer").ids, 2: model.encode("lowest").ids}


def test_batch_plan(spark):
    assert T.steps_for(4500, 4, 4, 5) == 1410
    assert T.steps_for(4500, 4, 4, 5, max_steps=5) == 5
    row = T.batch_plan(spark.range(4500)).first()
    assert tuple(row) == (4500, 16, 1410, True)
    row = T.batch_plan(spark.range(4500), max_steps=5).first()
    assert tuple(row) == (4500, 16, 5, False)
