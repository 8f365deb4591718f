import os

import pytest

from tunelake.operators import inference
from tunelake.operators.inference import infer_missing, stored_answers


@pytest.fixture
def counted(tmp_path):
    """A model that notes every prompt it answers, and one that fails at some of them."""
    log = str(tmp_path / "calls")

    def make(failing=()):
        def factory(*run):
            def model(prompts, params):
                for prompt in prompts:
                    if prompt in failing:
                        raise ValueError("the model is gone")
                with open(log, "a") as f:
                    f.writelines(f"{prompt}\n" for prompt in prompts)
                return [f"{run}{p}|{params['top_p']}" for p in prompts]

            return model

        return factory

    def calls():
        if not os.path.exists(log):
            return []
        with open(log) as f:
            return f.read().split()

    return make, calls


def test_only_missing_prompts_are_asked(spark, make, tmp_path, counted, rows):
    model, calls = counted
    folder = str(tmp_path / "answers")
    df = make([(i, f"p{i % 30}") for i in range(60)], "id int, prompt string")
    out = infer_missing(df.filter("id < 20"), model(), folder, blocks=4)
    assert rows(out, "id", "full_output") == sorted(((i, f"()p{i}|0.95") for i in range(20)), key=repr)
    assert sorted(calls()) == sorted(f"p{i}" for i in range(20))
    out = infer_missing(df, model(), folder, blocks=7)  # other blocks: answers are found all the same
    assert rows(out, "id", "full_output") == sorted(((i, f"()p{i % 30}|0.95") for i in range(60)), key=repr)
    assert sorted(calls()) == sorted(f"p{i}" for i in range(30))  # each prompt once
    infer_missing(df.filter("id = 3"), model(), folder, params={"top_p": 0.5}).collect()
    assert len(calls()) == 31
    out = infer_missing(df.limit(0), model(), folder)
    assert out.columns == ["id", "prompt", "full_output"] and out.count() == 0


def test_a_failure_keeps_finished_blocks(spark, make, tmp_path, counted):
    model, calls = counted
    folder = str(tmp_path / "answers")
    df = make([(i, f"p{i}") for i in range(200)], "id int, prompt string")
    with pytest.raises(Exception, match="the model is gone"):
        infer_missing(df, model({"p77"}), folder, blocks=40, batch_size=1)
    kept = stored_answers(spark, folder).count()
    asked = len(set(calls()))
    assert 0 < kept < 200 and asked - kept <= 200  # what was asked beyond is in the failed block
    before = calls()
    infer_missing(df, model(), folder, blocks=40).count()
    again = set(calls()[len(before):]) & set(before)
    assert len(calls()) - len(before) == 200 - kept and len(again) <= asked - kept < 20
    assert stored_answers(spark, folder).count() == 200


def test_answers_belong_to_runs(make, tmp_path, counted):
    model, calls = counted
    df = make([(i, f"p{i}", r) for i in range(6) for r in ("x", "y")], "id int, prompt string, run string")
    for _ in range(2):
        got = infer_missing(df, model(), str(tmp_path / "a"), run_column="run").collect()
        assert len(got) == 12 and all(r.full_output == f"('{r.run}',){r.prompt}|0.95" for r in got)
    assert len(calls()) == 12


def test_a_block_reads_its_own_prompts_only(spark, make, tmp_path, counted, monkeypatch):
    model, _ = counted
    parts, infer = [], inference.batch_infer

    def noted(part, *args, **how):
        parts.append(part)
        return infer(part, *args, **how)

    monkeypatch.setattr(inference, "batch_infer", noted)
    df = make([(i, f"p{i}") for i in range(100)], "id int, prompt string")
    infer_missing(df, model(), str(tmp_path / "a"), blocks=12)
    files = [f for part in parts for f in part.inputFiles()]
    assert len(parts) == 12 and len(files) == len(set(files))  # no file is read for two blocks
    assert sum(spark.read.parquet(f).count() for f in files) == 100


def test_null_empty_and_repeated_prompts(make, tmp_path, counted, rows):
    model, calls = counted
    folder = str(tmp_path / "answers")
    df = make([(1, None), (1, None), (2, ""), (3, "p"), (3, "p"), (4, "p")], "id int, prompt string")
    want = [(1, "()None|0.95")] * 2 + [(2, "()|0.95")] + [(3, "()p|0.95")] * 2 + [(4, "()p|0.95")]
    for _ in range(2):
        assert rows(infer_missing(df, model(), folder, blocks=3), "id", "full_output") == want
    assert len(calls()) == 2  # an empty line is no call here
