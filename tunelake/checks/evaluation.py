"""Queries over model outputs and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.checks import fixtures as X
from tunelake.checks.examples import REC, dump_sql
from tunelake.checks.registry import query
from tunelake.constants import ASSISTANT_MARKER, INFERENCE_INSTRUCTION, RECORD_FIELDS
from tunelake.functions.strict_json import extract_json, parse_or_error
from tunelake.functions.templates import inference_prompt
from tunelake.functions.text import after_last_marker, strip_prompt
from tunelake.operators import evaluation as E
from tunelake.operators.inference import batch_infer, infer_missing, run_sample_grid
from tunelake.session import new_folder, ship_package
from tunelake.sources.single_file import read_results_file, write_results_file
from tunelake.sources.sinks import write_eval_results

_FIELDS = ["cancer_type", "stage"]
_WS = "chr(32) || chr(9) || chr(10)"

# Rules 1 to 7 of the predictions as match flags: 2 changes nothing where the field is null anyway.
_SCORED = f"""{REC}, scored as (
  select id, {{}} from rec)"""
_MATCH = {
    "match": "id % 11 not in (1, 3, 4, 6, 7) and not (id % 11 = 2 and response is not null)",
    **{f"{f}_match": "id % 11 not in (6, 7)" for f in RECORD_FIELDS},
}
_MATCH["stage_match"] += " and id % 11 <> 1"
_MATCH["response_match"] += " and not (id % 11 = 2 and response is not null)"
_MATCH["metastasis_site_match"] += " and not (id % 11 = 4 and metastasis_site is not null)"
_FLAGS = ", ".join(f"{test} as {name}" for name, test in _MATCH.items())
_SCORES = _SCORED.format(_FLAGS)


def _scored(spark, sf):
    return E.score_predictions(X.expected(spark, sf), X.predicted(spark, sf), ["id"])


@query("exact_match", f"""with {REC}
select id, {_FLAGS}, case when id % 11 in (6, 7) then 'Failed to parse JSON' end as error,
  case when id % 11 = 7 then 'Answer: ' || {dump_sql(RECORD_FIELDS)} end as raw
from rec""")
def exact_match(spark, sf):
    return _scored(spark, sf)


@query("exact_match_accuracy", f"""with {_SCORES}
select count(*) as samples, count(*) filter (match) as correct,
  round(count(*) filter (match) * 100.0 / count(*), 6) as accuracy_pct from scored""")
def accuracy(spark, sf):
    return E.exact_match_accuracy(_scored(spark, sf)).withColumn(
        "accuracy_pct", F.round("accuracy_pct", 6)
    )


_FIELD_ROWS = " union all ".join(
    f"select '{f}' as field, round(count(*) filter ({f}_match) * 100.0 / count(*), 6) as accuracy_pct from scored"
    for f in RECORD_FIELDS
)


@query("field_accuracy", f"with {_SCORES} {_FIELD_ROWS}")
def field_accuracy(spark, sf):
    return E.field_accuracy(_scored(spark, sf)).withColumn("accuracy_pct", F.round("accuracy_pct", 6))


@query("eval_results_json", f"with {_SCORES} select id, match, stage_match from scored")
def eval_results(spark, sf):
    folder = new_folder(spark, "results")
    rows = _scored(spark, sf).select("id", "match", "stage_match")
    write_eval_results(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


@query("eval_results_list", f"with {_SCORES} select id, match, stage_match from scored")
def eval_list(spark, sf):
    """One JSON list, read back by ranges of the file."""
    path = f"{new_folder(spark, 'results')}/evaluation_results.json"
    rows = _scored(spark, sf).select("id", "match", "stage_match")
    write_results_file(rows, path, ["id"])
    return read_results_file(spark, path, rows.schema)


@query("open_match", """
select p_partkey as id, p_partkey % 11 not in (1, 3, 4, 6, 7)
  and not (p_partkey % 11 = 2 and p_partkey % 7 <> 0) as same
from part""")
def open_match(spark, sf):
    both = X.expected(spark, sf).join(X.predicted(spark, sf), "id")
    return E.dealt_out(both).select(
        "id", E.same_object(F.col("expected_json"), F.col("predicted_json")).alias("same")
    )


@query("parse_or_error", f"""with {REC}
select id, case when id % 11 in (6, 7) then 'Failed to parse JSON' end as error,
  case when id % 11 = 7 then 'Answer: ' || {dump_sql(RECORD_FIELDS)} end as raw,
  case when id % 11 = 1 then 'changed' when id % 11 not in (6, 7) then stage end as stage
from rec""")
def whole_text(spark, sf):
    return parse_or_error(X.predicted(spark, sf), "predicted_json").select(
        "id", "error", "raw", F.col("predicted.stage").alias("stage")
    )


_RULE = "(conv_id + turn) % 8"
_STATUS = f"""case {_RULE} when 0 then 'ok' when 1 then 'ok' when 2 then 'ok' when 3 then 'no_json'
  when 4 then 'malformed' when 5 then 'empty' else 'malformed' end"""


@query("extract_json", f"""
select conv_id, turn, {_STATUS} as status,
  case when {_RULE} < 3 then 'c' || conv_id end as cancer_type, null::varchar as stage
from conversations where role = 'assistant'""")
def recover(spark, sf):
    out = extract_json(X.answers(spark, sf), "generated", _FIELDS)
    return out.select("conv_id", "turn", "status", "record.*")


@query("parse_rate", f"""with s as (
  select {_STATUS} as status from conversations where role = 'assistant'),
n as (select status, count(*) as outputs from s group by status)
select x.status, coalesce(outputs, 0) as outputs,
  round(coalesce(outputs, 0) * 100.0 / (select count(*) from s), 6) as share_pct
from (values ('ok'), ('empty'), ('no_json'), ('malformed')) x(status) left join n on n.status = x.status""")
def parse_rate(spark, sf):
    out = extract_json(X.answers(spark, sf), "generated", _FIELDS)
    return E.parse_rate(out).withColumn("share_pct", F.round("share_pct", 6))


@query("strip_prompt", f"""
select a.conv_id, a.turn, trim(b.text, {_WS}) as generated
from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1
where a.role = 'user' and b.role = 'assistant'""")
def stripped(spark, sf):
    turns = X.table(spark, sf, "conversations")
    users = turns.filter("role = 'user'").select(
        "conv_id", "turn", inference_prompt(F.col("text")).alias("prompt")
    )
    replies = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    full = F.concat("prompt", F.lit("\n  "), "reply", F.lit(" \t\n"))
    return users.join(replies, ["conv_id", "turn"]).select(
        "conv_id", "turn", strip_prompt(full, F.col("prompt")).alias("generated")
    )


@query("after_last_marker", f"""
select conv_id, turn, trim(text, {_WS}) as answer from conversations""")
def last_answer(spark, sf):
    return X.chat_outputs(spark, sf).select(
        "conv_id", "turn", after_last_marker(F.col("full_text"), ASSISTANT_MARKER).alias("answer")
    )


def _stub_factory():
    def run(prompts, params):
        return [f'{p}{{"stage": "{len(p)}/{params["max_new_tokens"]}"}}' for p in prompts]

    return run


@query("batch_infer", f"""
select doc_id, length(text) + {len(INFERENCE_INSTRUCTION) + 26} as prompt_length, 'ok' as status,
  length(text) + {len(INFERENCE_INSTRUCTION) + 26} || '/512' as stage
from documents""")
def infer(spark, sf):
    ship_package(spark)
    prompts = X.table(spark, sf, "documents").select(
        "doc_id", inference_prompt(F.col("text")).alias("prompt")
    )
    outputs = batch_infer(prompts, _stub_factory, "doc_id")
    answers = outputs.select(
        "doc_id",
        F.length("prompt").alias("prompt_length"),
        strip_prompt(F.col("full_output"), F.col("prompt")).alias("generated"),
    )
    return extract_json(answers, "generated", ["stage"]).select(
        "doc_id", F.col("prompt_length").cast("bigint").alias("prompt_length"), "status", "record.stage"
    )


@query("infer_missing", f"""
select doc_id, length(text) + {len(INFERENCE_INSTRUCTION) + 26} as prompt_length,
  length(text) + {len(INFERENCE_INSTRUCTION) + 26} || '/512' as stage
from documents""")
def infer_resumed(spark, sf):
    """A third of the documents is answered before; the second call asks for the others."""
    ship_package(spark)
    folder = new_folder(spark, "answers")
    prompts = X.table(spark, sf, "documents").select(
        "doc_id", inference_prompt(F.col("text")).alias("prompt")
    )
    for rows in (prompts.filter("doc_id % 3 = 0"), prompts):
        outputs = infer_missing(rows, _stub_factory, folder, blocks=4)
    answers = outputs.select(
        "doc_id",
        F.length("prompt").cast("bigint").alias("prompt_length"),
        strip_prompt(F.col("full_output"), F.col("prompt")).alias("generated"),
    )
    return extract_json(answers, "generated", ["stage"]).select("doc_id", "prompt_length", "record.stage")


@query("run_sample_grid", """
select doc_id, lang, unnest(['20251110_120000', '20251111_022951']) as run from documents""")
def sample_grid(spark, sf):
    samples = X.table(spark, sf, "documents").select("doc_id", "lang")
    return run_sample_grid(samples, ["20251110_120000", "20251111_022951"])


def _changed(field: str) -> str:
    cases = [f"when id % 11 in (6, 7) then null when id % 11 = {{}} then {{}} else {field} end"]
    rule = {"stage": (1, "'changed'"), "response": (2, "null"), "metastasis_site": (4, "null")}
    number, value = rule.get(field, (99, "null"))
    return f"case {cases[0].format(number, value)}"


_PAIRS = " union all ".join(
    f"select id, '{f}' as field, {f} as value_a, {_changed(f)} as value_b from rec"
    for f in RECORD_FIELDS
)


@query("compare_runs", f"""with {REC}, pairs as ({_PAIRS})
select id, field, value_a, value_b from pairs where value_a is distinct from value_b""")
def compare(spark, sf):
    first = parse_or_error(
        X.expected(spark, sf).withColumnRenamed("expected_json", "j"), "j"
    ).select("id", F.lit("run-a").alias("run"), "predicted.*")
    second = parse_or_error(
        X.predicted(spark, sf).withColumnRenamed("predicted_json", "j"), "j"
    ).select("id", F.lit("run-b").alias("run"), "predicted.*")
    return E.compare_runs(first.unionByName(second), "run-a", "run-b", ["id"])


def _run_factory(run):
    def write(prompts, params):
        return [f'{p}{{"stage": "{len(p) % 3 if run == "older" else len(p) % 2}", "response": "{run}"}}'
                for p in prompts]

    return write


@query("grid_compare", f"""with n as (
  select doc_id, length(text) + {len(INFERENCE_INSTRUCTION) + 26} as prompt_length from documents)
select doc_id, 'response' as field, 'older' as value_a, 'newer' as value_b from n
union all select doc_id, 'stage', (prompt_length % 3)::varchar, (prompt_length % 2)::varchar
from n where prompt_length % 3 <> prompt_length % 2""")
def grid_compare(spark, sf):
    ship_package(spark)
    samples = X.table(spark, sf, "documents").select(
        "doc_id", inference_prompt(F.col("text")).alias("prompt")
    )
    grid = run_sample_grid(samples, ["older", "newer"])
    outputs = batch_infer(grid, _run_factory, "doc_id", run_column="run").withColumn(
        "generated", strip_prompt(F.col("full_output"), F.col("prompt"))
    )
    found = extract_json(outputs, "generated", ["stage", "response"])
    return E.compare_runs(
        found.select("run", "doc_id", "record.*"), "older", "newer", ["doc_id"], ["stage", "response"]
    )


# Rule, expected, predicted (p for the part's number), whether they are equal.
_TYPED = [
    ('{"stage":"p"}', '{"stage":p}', False),
    ('{"stage":p}', '{"stage":p.00}', True),
    ('{"stage":"true"}', '{"stage":true}', False),
    ('{"stage":{"b":[p,null],"a":"x"}}', '{"stage":{"a":"x","b":[p.0,null]}}', True),
    ('{"stage":"p","note":"a"}', '{"stage":"p","note":"b"}', False),
    ('{"stage":"x","stage":"p"}', '{"stage":"p"}', True),
    ('{"stage":"p.0"}', '{"stage":"p"}', False),
    ('{"note":p,"stage":null}', '{"stage":null,"note":p}', True),
]


def _cases(side: int) -> str:
    return " ".join(
        f"when p_partkey % {len(_TYPED)} = {rule} then replace('{pair[side]}', 'p', p_partkey::string)"
        for rule, pair in enumerate(_TYPED)
    )


@query("typed_match", "select p_partkey as id, case " + " ".join(
    f"when p_partkey % {len(_TYPED)} = {rule} then {equal} when false then false"
    for rule, (_, _, equal) in enumerate(_TYPED)
) + """ end as match,
  case when p_partkey % 8 = 4 then true when p_partkey % 8 in (0, 2, 6) then false else true end as stage_match
from part""")
def typed_match(spark, sf):
    part = X.table(spark, sf, "part")
    expected = part.selectExpr("p_partkey as id", f"case {_cases(0)} end as expected_json")
    predicted = part.selectExpr("p_partkey as id", f"case {_cases(1)} end as predicted_json")
    return E.score_predictions(expected, predicted, ["id"], ["stage"]).select(
        "id", "match", "stage_match"
    )
