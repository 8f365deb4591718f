"""Queries over instruction examples, training texts, tokens and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.checks import fixtures as X
from tunelake.checks.registry import query
from tunelake.constants import INFERENCE_INSTRUCTION, RECORD_FIELDS
from tunelake.functions.strict_json import check_record_schema, dumps_record, select_fields
from tunelake.functions.templates import chat_prompt, format_training_text, inference_prompt
from tunelake.operators import dataset as D
from tunelake.operators import tokens as T
from tunelake.plans.training import prepare_training_table, training_batches
from tunelake.session import new_folder
from tunelake.sources.examples import (
    load_splits,
    parse_example_lines,
    read_examples,
    read_rejects,
    store_examples,
)
from tunelake.sources.single_file import write_in_order

REC = """
rec as (
  select p_partkey as id, p_name as input, p_type as cancer_type, p_size::varchar as stage,
    case when p_partkey % 3 <> 0 then p_brand end as gene_mutation,
    case when p_partkey % 5 <> 0 then p_brand || '; ' || p_type end as biomarker,
    p_name as treatment,
    case when p_partkey % 7 <> 0 then 'stable "disease"' end as response,
    case when p_partkey % 2 <> 0 then 'brain, liver' end as metastasis_site
  from part)
"""

SYSTEM = (
    "'<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || "
    "'You are a medical information extraction assistant. Extract structured cancer-related "
    "entities from clinical text.<|eot_id|><|start_header_id|>user<|end_header_id|>' || "
    "chr(10) || chr(10)"
)
ASSISTANT = "'<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)"


def dump_sql(fields: list[str], prefix: str = "") -> str:
    """A record of ``rec`` as JSON text, in SQL."""
    parts = [
        f"""'"{f}": ' || coalesce(to_json({prefix}{f})::varchar, 'null')""" for f in fields
    ]
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


_FIELDS = ", ".join(RECORD_FIELDS)
_FLAT = [f"output.{f}" for f in RECORD_FIELDS]
_REASON = """case p_partkey % 11 when 1 then 'blank' when 2 then 'malformed' when 3 then 'not_object'
  when 4 then 'missing_key' when 5 then 'malformed' end"""


def _files_of_lines(spark, sf):
    folder = new_folder(spark, "lines")
    X.example_lines(spark, sf).select("value").write.text(folder)
    return folder


@query("read_examples", f"""with {REC}
select '{INFERENCE_INSTRUCTION}' as instruction, input, {_FIELDS}
from rec where id % 11 not in (1, 2, 3, 4, 5)""")
def read_good(spark, sf):
    good, _ = read_examples(spark, _files_of_lines(spark, sf))
    return good.select("instruction", "input", *_FLAT)


@query("example_rejects", f"""
select reason, count(*) as lines from (select {_REASON} as reason from part) where reason is not null
group by reason""")
def reject_counts(spark, sf):
    _, rejects = read_examples(spark, _files_of_lines(spark, sf))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query("example_line_numbers", f"""
with numbered as (select row_number() over (order by p_partkey) as line_no, {_REASON} as reason from part)
select line_no, reason from numbered where reason is not null""")
def reject_lines(spark, sf):
    """One file, in order, read in many splits."""
    path = f"{new_folder(spark, 'lines')}/train.jsonl"
    lines = X.example_lines(spark, sf).repartition(7).select("id", "value")
    write_in_order(lines, path, ["id"], _line_text, b"", b"")
    return read_rejects(spark, path).select("line_no", "reason")


def _line_text(batch):
    return "".join(value + "\n" for value in batch.column("value").to_pylist())


@query("example_reasons", f"select p_partkey as id, {_REASON} as reason from part")
def example_reasons(spark, sf):
    return parse_example_lines(X.example_lines(spark, sf)).select("id", "reason")


@query("store_examples", f"""
select p_partkey as id, case when p_partkey % 11 not in (1, 2, 3, 4, 5) then p_name end as input,
  {_REASON} as reason
from part""")
def stored_examples(spark, sf):
    parsed = parse_example_lines(X.example_lines(spark, sf))
    good, rejects = store_examples(parsed, new_folder(spark, "examples"))
    return good.select("id", "input", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select("id", F.lit(None).cast("string").alias("input"), "reason")
    )


@query("dumps_record", f"with {REC} select id, {dump_sql(RECORD_FIELDS)} as json from rec")
def dumps(spark, sf):
    return X.examples(spark, sf).select("id", dumps_record(F.col("output")).alias("json"))


_TRAINING_TEXT = (
    f"{SYSTEM} || '{INFERENCE_INSTRUCTION}' || chr(10) || chr(10) || 'Text: ' || input || "
    f"{ASSISTANT} || {dump_sql(RECORD_FIELDS)} || '<|eot_id|>'"
)


@query("format_training_text", f"""with {REC}
select id, case when id % 10 = 0 then 'validation' else 'train' end as split, {_TRAINING_TEXT} as text
from rec""")
def training_text(spark, sf):
    return format_training_text(X.examples(spark, sf))


@query("chat_prompt", f"""
select conv_id, turn, {SYSTEM} || coalesce(case when turn > 0 then role end, 'None') || chr(10) || chr(10)
  || 'Text: ' || text || {ASSISTANT} as prompt
from conversations""")
def chat(spark, sf):
    role = F.when(F.col("turn") > 0, F.col("role"))
    return X.table(spark, sf, "conversations").select(
        "conv_id", "turn", chat_prompt(role, F.col("text")).alias("prompt")
    )


@query("inference_prompt", f"""
select doc_id, '{INFERENCE_INSTRUCTION}' || chr(10) || chr(10) || text || chr(10) || chr(10)
  || 'Output (JSON format):' || chr(10) as prompt
from documents""")
def plain_prompt(spark, sf):
    return X.table(spark, sf, "documents").select(
        "doc_id", inference_prompt(F.col("text")).alias("prompt")
    )


@query("select_fields", f"with {REC} select id, {_FIELDS} from rec")
def fields(spark, sf):
    return select_fields(X.examples(spark, sf).select("id", "output"), "output")


@query("record_schema_check", """
select p_partkey as id,
  case p_partkey % 11 when 4 then 'metastasis_site'
    when 6 then 'biomarker,cancer_type,gene_mutation,metastasis_site,response,stage,treatment'
    when 7 then 'biomarker,cancer_type,gene_mutation,metastasis_site,response,stage,treatment'
    else '' end as missing,
  case p_partkey % 11 when 3 then 'other' else '' end as extra,
  p_partkey % 11 not in (3, 4, 6, 7) as schema_ok
from part""")
def schema_check(spark, sf):
    checked = check_record_schema(X.predicted(spark, sf), "predicted_json")
    return checked.select(
        "id",
        F.array_join(F.array_sort("missing"), ",").alias("missing"),
        F.array_join(F.array_sort("extra"), ",").alias("extra"),
        "schema_ok",
    )


@query("count_examples", """
select case when p_partkey % 10 = 0 then 'validation' else 'train' end as split, count(*) as examples
from part where p_partkey % 11 not in (1, 2, 3, 4, 5) group by all""")
def count_examples(spark, sf):
    lines = X.example_lines(spark, sf).withColumn(
        "split", F.when(F.col("id") % 10 == 0, "validation").otherwise("train")
    )
    return D.count_examples(parse_example_lines(lines).filter("reason is null"))


@query("load_splits", """
select p_partkey as id, p_name as input, 'train' as split from part
union all select doc_id as id, text as input, 'validation' as split from documents""")
def splits(spark, sf):
    train = X.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("input"))
    validation = X.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("input")
    )
    return load_splits({"train": train, "validation": validation})


_SHARES = ", ".join(
    f"round(avg(({f} is null)::int), 6) as {f}_null_share" for f in RECORD_FIELDS
)


@query("profile_dataset", f"""with {REC}
select count(*) as examples, round(avg(length(input)), 6) as mean_tokens,
  max(length(input))::int as max_tokens, count(*) filter (length(input) > 12) as over_limit,
  7 as fields, {_SHARES}
from rec""")
def profile(spark, sf):
    examples = X.examples(spark, sf).withColumn("n_tokens", F.size(T.character_ids(F.col("input"))))
    out = D.profile_dataset(examples, max_len=12)
    shares = [f"{f}_null_share" for f in RECORD_FIELDS]
    return out.withColumns({c: F.round(c, 6) for c in ["mean_tokens", *shares]})


@query("batch_plan", """
select count(*) as examples, 16 as effective_batch,
  (ceil(count(*) / 16.0) * 5)::bigint as total_steps, true as saves_checkpoints
from part""")
def batch_plan(spark, sf):
    return T.batch_plan(X.examples(spark, sf))


_TOKENS = """tok as (
  select doc_id, length(text) as n_tokens, least(length(text), 2048) as kept,
    list_transform(string_split(text, '')[1:2048], lambda c: unicode(c)) as ids
  from documents)"""


@query("tokenize_truncate", f"""with {_TOKENS}
select doc_id, n_tokens::int as n_tokens, n_tokens > 2048 as was_truncated, kept::int as kept,
  list_sum(ids)::bigint as id_sum, ids[1]::int as first_id, ids[-1]::int as last_id
from tok""")
def tokenize_characters(spark, sf):
    out = T.tokenize(X.table(spark, sf, "documents"), T.character_ids(F.col("text")))
    return out.select(
        "doc_id",
        "n_tokens",
        "was_truncated",
        F.size(F.array_remove("attention_mask", 0)).alias("kept"),
        F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("id_sum"),
        F.element_at("input_ids", 1).alias("first_id"),
        F.element_at("input_ids", -1).alias("last_id"),
    )


@query("tokenize_words", r"""
select doc_id, len(regexp_split_to_array(trim(text, chr(32) || chr(10)), '\s+'))::int as n_tokens,
  len(regexp_split_to_array(trim(text, chr(32) || chr(10)), '\s+')) > 128 as was_truncated
from documents""")
def tokenize_words(spark, sf):
    out = T.tokenize(X.table(spark, sf, "documents"), max_len=128)
    return out.select("doc_id", "n_tokens", "was_truncated")


_BATCHES = f"""{_TOKENS}, numbered as (
  select *, (row_number() over (order by doc_id) - 1) // 4 as batch_id from tok),
batches as (select *, max(kept) over (partition by batch_id) as batch_length from numbered)"""


def _collated(spark, sf, **options):
    tokenised = T.tokenize(
        X.table(spark, sf, "documents").select("doc_id", "text"), T.character_ids(F.col("text"))
    )
    return T.collate(tokenised, "doc_id", pad_id=32, **options)


@query("collate_batches", f"""with {_BATCHES}
select doc_id, batch_id, batch_length::int as batch_length, (batch_length - kept)::int as n_padding,
  batch_length::int as width, kept::int as mask_sum,
  (list_sum(ids) + 32 * (batch_length - kept))::bigint as id_sum,
  (len(list_filter(ids, lambda i: i = 32)) + batch_length - kept)::int as ignored
from batches""")
def collate_batches(spark, sf):
    return _collated(spark, sf).select(
        "doc_id",
        "batch_id",
        "batch_length",
        "n_padding",
        F.size("input_ids").alias("width"),
        F.size(F.array_remove("attention_mask", 0)).alias("mask_sum"),
        F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("id_sum"),
        (F.size("labels") - F.size(F.array_remove("labels", -100))).alias("ignored"),
    )


@query("padding_waste", f"""with {_BATCHES}
select count(distinct batch_id) as batches, sum(batch_length)::bigint as cells,
  sum(batch_length - kept)::bigint as padding_cells,
  round(sum(batch_length - kept) * 100.0 / sum(batch_length), 6) as waste_pct
from batches""")
def padding_waste(spark, sf):
    return T.padding_waste(_collated(spark, sf)).withColumn("waste_pct", F.round("waste_pct", 6))


@query("collate_by_length", f"""with {_TOKENS}, numbered as (
  select *, (row_number() over (order by kept, doc_id) - 1) // 4 as batch_id from tok)
select doc_id, batch_id, max(kept) over (partition by batch_id)::int as batch_length from numbered""")
def collate_by_length(spark, sf):
    return _collated(spark, sf, sort_by_length=True).select("doc_id", "batch_id", "batch_length")


_FLOW = f"""with {REC}, texts as (
  select case when id % 10 = 0 then 'validation' else 'train' end as split,
    length({_TRAINING_TEXT})::int as n_tokens
  from rec where id % 11 not in (1, 2, 3, 4, 5))"""


def _training_table(spark, sf):
    lines = X.example_lines(spark, sf)
    paths = {}
    for split, rows in {"train": lines.filter("id % 10 <> 0"), "validation": lines.filter("id % 10 = 0")}.items():
        paths[split] = new_folder(spark, split)
        rows.select("value").write.text(paths[split])
    return prepare_training_table(spark, paths, T.character_ids(F.col("text")), 512)[0]


@query("training_table", f"""{_FLOW}
select split, n_tokens, n_tokens > 512 as was_truncated, count(*) as examples
from texts group by all""")
def training_table(spark, sf):
    return _training_table(spark, sf).groupBy("split", "n_tokens", "was_truncated").agg(
        F.count(F.lit(1)).alias("examples")
    )


@query("training_flow", f"""{_FLOW}, numbered as (
  select split, least(n_tokens, 512) as length,
    (row_number() over (partition by split order by least(n_tokens, 512)) - 1) // 4 as batch_id
  from texts)
select split, batch_id, count(*) as examples, max(length) as width,
  sum(max_length - length)::bigint as padding
from (select *, max(length) over (partition by split, batch_id) as max_length from numbered)
group by split, batch_id""")
def training_flow(spark, sf):
    batches = training_batches(_training_table(spark, sf), pad_id=32, sort_by_length=True)
    return batches.groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("examples"),
        F.max(F.size("input_ids")).alias("width"),
        F.sum("n_padding").alias("padding"),
    )
