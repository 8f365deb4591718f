"""Queries over runs, checkpoints and artifacts."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import functions as F

from tunelake.checks import fixtures as X
from tunelake.checks.metrics import M
from tunelake.checks.registry import query
from tunelake.functions.paths import checkpoint_step, run_started_at
from tunelake.operators import catalog as C
from tunelake.session import new_folder, written
from tunelake.sources.artifacts import (
    artifact_manifest,
    exclude_paths,
    list_artifacts,
    list_runs,
    relative_keys,
    with_run,
)
from tunelake.sources.publish import publish_runs, published_runs
from tunelake.sources.sinks import write_runs_partitioned

ART = f"""
n as (
  select *, date_trunc('hour', ts) as hr from events),
art as (
  select '{X.BASE}/' || case event_id % 50 when 7 then strftime(hr, '%Y') || '1301_000000'
      when 8 then strftime(hr, '%Y%m%d-%H%M%S') when 9 then strftime(hr, '%Y%m%d_%H%M')
      else strftime(hr, '%Y%m%d_%H%M%S') end
    || '/' || case event_type when 'error' then 'final_model/adapter_config.json'
      when 'click' then 'final_model/adapter_model.safetensors'
      when 'view' then 'logs/events.out.' || event_id
      when 'signup' then 'checkpoint-' || (200 * (event_id % 13 + 1)) || '/trainer_state.json'
      else 'backup_1/checkpoint-' || (event_id % 9) || '/x.pt' end as path,
    event_id * 1000 + 17 as length
  from n),
inr as (select *, split_part(path, '/', 3) as run,
    substr(path, length('{X.BASE}/') + length(split_part(path, '/', 3)) + 2) as inside from art),
runs as (
  select distinct run, strftime(strptime(run, '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S') as formatted_date
  from inr where regexp_full_match(run, '[0-9]{{8}}_[0-9]{{6}}')
    and try_strptime(run, '%Y%m%d_%H%M%S') is not null)
"""


def _listing(spark, sf):
    """The artifacts as a stored listing."""
    return written(X.artifacts(spark, sf), "listing")


def _runs(spark, sf):
    return list_runs(_listing(spark, sf), X.BASE)


def _inside(spark, sf):
    return with_run(_listing(spark, sf), X.BASE)


def _runs_and_inside(spark, sf):
    listing = _listing(spark, sf)
    return list_runs(listing, X.BASE), with_run(listing, X.BASE)


@query("list_runs", f"""with {ART}
select run, '{X.BASE}/' || run as prefix, '{X.BASE}/' || run || '/logs/' as logs_prefix, formatted_date
from runs""")
def runs(spark, sf):
    return _runs(spark, sf).drop("started_at")


@query("parse_run_timestamp", f"""with {ART}
select path, strftime(case when regexp_full_match(run, '[0-9]{{8}}_[0-9]{{6}}')
  then try_strptime(run, '%Y%m%d_%H%M%S') end, '%Y-%m-%d %H:%M:%S') as started_at
from inr""")
def started_at(spark, sf):
    return _inside(spark, sf).select(
        "path",
        F.date_format(run_started_at(F.col("run")), "yyyy-MM-dd HH:mm:ss").alias("started_at"),
    )


@query("runs_with_logs", f"""with {ART}
select run, formatted_date from runs where run in (select run from inr where inside like 'logs/%')""")
def with_logs(spark, sf):
    return C.runs_with_logs(*_runs_and_inside(spark, sf)).select("run", "formatted_date")


@query("latest_run", f"""with {ART}
select run, formatted_date from runs order by formatted_date desc, run desc limit 1""")
def latest(spark, sf):
    return C.latest_run(_runs(spark, sf)).select("run", "formatted_date")


@query("select_run", f"""with {ART}
select run, formatted_date from runs where run = '20240102_030000'""")
def chosen(spark, sf):
    return C.select_run(_runs(spark, sf), "20240102_030000").select("run", "formatted_date")


@query("checkpoint_step", """
select event_id, case when event_id % 4 = 0 then null else event_id end as step from events""")
def step_of(spark, sf):
    eid = F.col("event_id")
    name = F.when(eid % 4 == 0, F.concat(F.lit("checkpoint-"), eid.cast("string"), F.lit("x"))).when(
        eid % 4 == 1, F.concat(F.lit("a-b/checkpoint-"), eid.cast("string"), F.lit("/"))
    ).otherwise(F.concat(F.lit("checkpoint-"), eid.cast("string")))
    return X.table(spark, sf, "events").select("event_id", checkpoint_step(name).alias("step"))


_CKPT = """ck as (
  select distinct run, step, 'checkpoint-' || step as path
  from m where tag = 'train/loss' and step % 200 = 0),
best as (
  select run, step, value, path from (
    select c.run, c.step, e.value, c.path,
      row_number() over (partition by c.run order by e.value, c.step) as n
    from ck c join (select * from f where tag = 'eval/loss') e on c.run = e.run and c.step = e.step)
  where n = 1)"""


@query("list_checkpoints", f"""with {ART}
select distinct run, split_part(split_part(inside, '/', 1), '-', 2)::bigint as step,
  split_part(inside, '/', 1) as path
from inr where inside like 'checkpoint-%'""")
def checkpoints_listed(spark, sf):
    return C.list_checkpoints(_inside(spark, sf))


@query("latest_checkpoint", f"with {M}, {_CKPT} select run, max(step) as step, 'checkpoint-' || max(step) as path from ck group by run")
def latest_checkpoint(spark, sf):
    return C.latest_checkpoint(X.checkpoints(spark, sf))


@query("best_checkpoint", f"with {M}, {_CKPT} select run, step, value, path from best")
def best_checkpoint(spark, sf):
    return C.best_checkpoint(X.metrics(spark, sf), X.checkpoints(spark, sf))


@query("retention_plan", f"""with {M}, {_CKPT}, r as (
  select *, row_number() over (partition by run order by step desc) as n from ck)
select run, step, path,
  n <= 3 or exists (select 1 from best b where b.run = r.run and b.step = r.step) as keep
from r""")
def retention(spark, sf):
    saved = X.checkpoints(spark, sf)
    return C.retention_plan(saved, C.best_checkpoint(X.metrics(spark, sf), saved))


@query("missing_required_files", f"""with {ART}
select run, missing_file from runs,
  (values ('adapter_config.json'), ('adapter_model.safetensors')) q(missing_file)
where not exists (select 1 from inr where inr.run = runs.run and inside = 'final_model/' || missing_file)""")
def missing_files(spark, sf):
    return C.missing_required_files(*_runs_and_inside(spark, sf))


@query("cleanup_plan", f"""with {ART}
select path, length, case split_part(inside, '/', 1) when 'final_model' then 'final_model'
    when 'logs' then 'other' when 'backup_1' then 'backup' else 'checkpoint' end as kind,
  case when split_part(inside, '/', 1) in ('final_model', 'logs') then 'keep' else 'delete' end as action
from inr""")
def cleanup(spark, sf):
    return C.cleanup_plan(X.artifacts(spark, sf), keep_final_model=True)


_PAGES = """p as (
  select 'pages/' || replace(url, '://', '/') || '/' || page_id as path,
    split_part(url, '/', 3) as host, strlen(html) as length from pages)"""


def _pages(spark, sf):
    return X.table(spark, sf, "pages").select(
        F.concat(
            F.lit("pages/"),
            F.replace("url", F.lit("://"), F.lit("/")),
            F.lit("/"),
            F.col("page_id").cast("string"),
        ).alias("path"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
        F.octet_length("html").cast("bigint").alias("length"),
    )


@query("artifact_summary", f"""with {_PAGES}
select host, count(*) as objects, sum(length)::bigint as bytes,
  round(sum(length) / 1048576.0, 2) as megabytes, greatest(count(*) - 10, 0) as more
from p group by host""")
def summary(spark, sf):
    return C.artifact_summary(_pages(spark, sf), ["host"])


@query("artifact_head", f"""with {_PAGES}, r as (
  select *, row_number() over (partition by host order by path) as place from p)
select host, place::int as place, path, round(length / 1048576.0, 2) as megabytes from r where place <= 10""")
def head_of_artifacts(spark, sf):
    return C.artifact_head(_pages(spark, sf), ["host"])


@query("head_by_key", """
select p_partkey, p_name from part order by p_partkey limit 100""")
def first_samples(spark, sf):
    return C.head_by_key(X.table(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], 100)


@query("exclude_paths", f"""with {_PAGES}
select path, length from p where not contains(path, '/en/') and not contains(path, 'page=')""")
def excluded(spark, sf):
    return exclude_paths(_pages(spark, sf), ["/en/", "page="]).select("path", "length")


@query("artifact_manifest", f"""with {_PAGES}
select path, substr(path, 7) as relative, 'backup/2024/' || substr(path, 7) as key
from p where not contains(path, '#top')""")
def manifest(spark, sf):
    out = artifact_manifest(_pages(spark, sf), "pages", "backup/2024/", ["#top"])
    return out.select("path", "relative", "key")


@query("relative_keys", f"""with {_PAGES}
select path, substr(path, 7) as relative from p""")
def relative(spark, sf):
    return relative_keys(_pages(spark, sf), "pages").select("path", "relative")


_NAMES = """files as (
  select case page_id % 4 when 0 then '.git' || page_id when 1 then '_part' || page_id
    when 2 then 'sub/.hid/f' || page_id else 'f' || page_id end as path, length(url) + 1 as length
  from pages where page_id % 4 is not null)"""


@query("list_artifacts", f"with {_NAMES} select path, length::bigint as length from files")
def files_on_disk(spark, sf):
    """One file for each page, hidden names among them, written by the tasks and listed again."""
    folder = new_folder(spark, "files")
    name = F.col("page_id").cast("string")
    number = F.col("page_id") % 4
    files = X.table(spark, sf, "pages").select(
        F.when(number == 0, F.concat(F.lit(".git"), name))
        .when(number == 1, F.concat(F.lit("_part"), name))
        .when(number == 2, F.concat(F.lit("sub/.hid/f"), name))
        .otherwise(F.concat(F.lit("f"), name))
        .alias("path"),
        "url",
    )

    def write(batches):
        for batch in batches:
            system, inside = fs.FileSystem.from_uri(folder if "://" in folder else _local(folder))
            for path, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{inside}/{path}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(target) as file:
                    file.write((url + "\n").encode())
            yield batch.select(["path"])

    files.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    listed = list_artifacts(spark, folder)
    return listed.select(F.regexp_extract("path", r"/files-[0-9a-f]+/(.*)$", 1).alias("path"), "length")


def _local(folder: str) -> str:
    return folder.removeprefix("file:")


@query("run_partitioned_write", f"with {M} select run, tag, step, value, ord from k")
def partitioned(spark, sf):
    base = new_folder(spark, "runs")
    rows = X.metrics(spark, sf).filter("tag <> 'train/grad_norm'").drop("wall_time")
    write_runs_partitioned(rows, base)
    return spark.read.parquet(base)


@query("published_runs", f"with {M} select run, tag, step, value, ord from k")
def published(spark, sf):
    """Two writers publish runs of their own; a third one, late with a run of the first, loses."""
    base = new_folder(spark, "published")
    rows = X.metrics(spark, sf).filter("tag <> 'train/grad_norm'").drop("wall_time")
    for runs in (["r0", "r1", "r2"], ["r3", "r4"]):
        publish_runs(rows.filter(F.col("run").isin(runs)), base)
    try:
        publish_runs(rows.filter("run in ('r2', 'r9')"), base)
    except FileExistsError:
        pass
    return published_runs(spark, base, rows.schema)
