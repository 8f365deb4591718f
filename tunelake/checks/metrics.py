"""Queries over run metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.checks import fixtures as X
from tunelake.checks.registry import query
from tunelake.constants import EVAL_LOSS, TRAIN_LOSS
from tunelake.operators import gap as G
from tunelake.operators import series as S
from tunelake.operators import summary as A
from tunelake.session import new_folder
from tunelake.sources.metrics import (
    TRAINER_STATE_SCHEMA,
    explode_metrics_map,
    explode_trainer_state,
    merge_metric_sources,
    parse_console_metrics,
    read_console_metrics,
    read_metric_events,
    read_trainer_state,
    trainer_state_header,
)
from tunelake.sources.single_file import write_metrics_file
from tunelake.sources.sinks import write_metrics_csv

M = """
m as (
  select 'r' || (user_id % 5)::varchar as run,
    case event_type when 'click' then 'train/loss' when 'view' then 'eval/loss'
      when 'signup' then 'train/learning_rate' when 'purchase' then 'train/epoch'
      when 'error' then 'train/grad_norm' end as tag,
    (case when event_type = 'view' then 15 * (event_id // 10)
      else 10 * greatest(0, event_id // 8 - case when event_id % 17 = 0 then 3 else 0 end)
      end)::bigint as step,
    value, epoch(ts) as wall_time, event_id as ord
  from events),
k as (select * from m where tag in ('train/loss', 'eval/loss', 'train/learning_rate', 'train/epoch')),
f as (select run, tag, step, value, wall_time, ord from
  (select *, row_number() over (partition by run, tag, step order by ord) as n from k) where n = 1),
a as (select *, row_number() over (partition by run, tag order by step, ord) as up,
    row_number() over (partition by run, tag order by step desc, ord desc) as down from k),
t as (select run, step, value from f where tag = 'train/loss'),
e as (select run, step, value from f where tag = 'eval/loss' and step >= 100),
lo as (select e.run, e.step, e.value, t.step as ls, t.value as lv
  from e asof left join t on e.run = t.run and e.step >= t.step),
hi as (select e.run, e.step, t.step as hs, t.value as hv
  from e asof left join t on e.run = t.run and e.step <= t.step),
g as (select run, step, value as eval_loss,
    case when ls is null then hv when hs is null or hs = ls then lv
      else (hv - lv) / (hs - ls) * (step - ls) + lv end as train_loss
  from lo join hi using (run, step) where lv is not null or hv is not null),
gap as (select *, eval_loss - train_loss as gap from g)
"""


def _kept(spark, sf):
    return S.filter_tags(X.metrics(spark, sf))


def _rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("metric_events", f"with {M} select run, tag, step, value, round(wall_time, 3) as wall_time, ord from m")
def metric_events(spark, sf):
    folder = new_folder(spark, "events")
    X.metrics(spark, sf).write.parquet(f"{folder}/deep/part")
    return read_metric_events(spark, folder).withColumn("wall_time", F.round("wall_time", 3))


@query("filter_tags", f"with {M} select run, tag, step, value, ord from k")
def filter_tags(spark, sf):
    return _kept(spark, sf).drop("wall_time")


@query("eval_warmup", f"with {M} select run, tag, step, value, ord from k where tag <> 'eval/loss' or step >= 100")
def eval_warmup(spark, sf):
    return S.filter_eval_warmup(_kept(spark, sf)).drop("wall_time")


@query("series_order", f"with {M} select run, tag, step, value, ord, up as rn from a")
def series_order(spark, sf):
    return S.series_order(_kept(spark, sf).drop("wall_time"))


@query("series_order_spread", f"with {M} select run, tag, step, value, ord, up as rn from a")
def series_order_spread(spark, sf):
    """The way taken when a series is too large for one task."""
    return S.series_order(_kept(spark, sf).drop("wall_time"))


@query("first_per_step", f"with {M} select run, tag, step, value, round(wall_time, 3) as wall_time, ord from f")
def first_per_step(spark, sf):
    return S.first_per_step(_kept(spark, sf)).withColumn("wall_time", F.round("wall_time", 3))


@query("metric_summary", f"""with {M}
select run, tag, round(max(case when down = 1 then value end), 6) as final_value,
  round(min(value), 6) as min_value, round(max(value), 6) as max_value,
  round(avg(value), 6) as mean_value
from a group by run, tag""")
def metric_summary(spark, sf):
    return _rounded(
        A.summarise_metrics(_kept(spark, sf)), "final_value", "min_value", "max_value", "mean_value"
    )


@query("improvement_pct", f"""with {M}, i as (
  select run, tag, max(case when up = 1 then value end) as first_value,
    max(case when down = 1 then value end) as final_value, count(*) as n
  from a where lower(tag) like '%loss%' group by run, tag)
select run, tag, first_value, final_value,
  round((first_value - final_value) / first_value * 100, 6) as improvement_pct
from i where n > 1""")
def improvement(spark, sf):
    return _rounded(A.improvement_pct(_kept(spark, sf)), "improvement_pct")


_WIDE = """select run, step, max(case when tag = 'train/loss' then value end) as train_loss,
  max(case when tag = 'eval/loss' then value end) as eval_loss,
  max(case when tag = 'train/learning_rate' then value end) as train_learning_rate,
  max(case when tag = 'train/epoch' then value end) as train_epoch
from f group by run, step"""


@query("pivot_metrics", f"with {M} {_WIDE}")
def pivot_metrics(spark, sf):
    return S.pivot_metrics(X.metrics(spark, sf))


@query("metrics_csv_roundtrip", f"with {M} {_WIDE}")
def metrics_csv_roundtrip(spark, sf):
    wide = S.pivot_metrics(X.metrics(spark, sf))
    folder = new_folder(spark, "csv")
    write_metrics_csv(wide, folder, ["run", "step"])
    return spark.read.schema(wide.schema).option("header", "true").csv(folder)


@query("metrics_csv_file", f"with {M} {_WIDE}")
def metrics_csv_file(spark, sf):
    """One file: its only header gives the names."""
    wide = S.pivot_metrics(X.metrics(spark, sf))
    path = f"{new_folder(spark, 'csv')}/metrics.csv"
    write_metrics_file(wide, path, ["run", "step"])
    rows = spark.read.option("header", "true").csv(path)
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in wide.schema))


@query("align_series", f"""with {M}
select coalesce(t.run, e.run) as run, coalesce(t.step, e.step) as step,
  t.value as train, e.value as evaluation
from t full join (select * from f where tag = 'eval/loss') e on t.run = e.run and t.step = e.step""")
def align_series(spark, sf):
    kept = X.metrics(spark, sf)
    train, evaluation = (S.filter_tags(kept, [t]) for t in (TRAIN_LOSS, EVAL_LOSS))
    return S.align_series(train, evaluation, ("train", "evaluation"))


@query("all_steps", f"with {M} select distinct run, step from k")
def all_steps(spark, sf):
    return S.all_steps(_kept(spark, sf))


@query("train_eval_gap", f"""with {M}
select run, step, eval_loss, round(train_loss, 9) as train_loss, round(gap, 9) as gap from gap""")
def train_eval_gap(spark, sf):
    return _rounded(G.train_eval_gap(X.metrics(spark, sf)), "train_loss", "gap", places=9)


@query("gap_summary", f"""with {M}, s as (
  select run, avg(gap) as mean_gap, arg_max(gap, step) as final_gap, arg_min(gap, step) as first_gap
  from gap group by run)
select run, round(mean_gap, 6) as mean_gap, round(final_gap, 9) as final_gap,
  case when abs(final_gap - first_gap) < 0.1 then 'stable'
    when final_gap > first_gap then 'increasing' else 'decreasing' end as trend
from s""")
def gap_summary(spark, sf):
    out = G.gap_summary(G.train_eval_gap(X.metrics(spark, sf)))
    return _rounded(_rounded(out, "mean_gap"), "final_gap", places=9)


@query("overfit_flags", f"""with {M}, l as (
  select *, lag(train_loss) over w as pt, lag(eval_loss) over w as pe
  from gap window w as (partition by run order by step))
select run, step, round(train_loss, 9) as train_loss, eval_loss, round(gap, 9) as gap,
  coalesce(train_loss < pt and eval_loss > pe, false) as overfitting,
  gap < 0.3 as gap_on_target, train_loss < 2.0 as train_on_target
from l""")
def overfit_flags(spark, sf):
    gap = G.train_eval_gap(X.metrics(spark, sf))
    return _rounded(G.overfit_flags(gap), "train_loss", "gap", places=9)


@query("argmin_metric", f"""with {M}, r as (
  select *, row_number() over (partition by run, tag order by value, step, ord) as n from k)
select run, tag, value as min_value, step as min_step from r where n = 1""")
def argmin_metric(spark, sf):
    return A.argmin_metric(_kept(spark, sf))


@query("running_best", f"""with {M}, r as (
  select run, step, value,
    min(value) over (partition by run order by step rows between unbounded preceding and 1 preceding) as before
  from f where tag = 'eval/loss')
select run, step, value, least(value, coalesce(before, value)) as best_value,
  coalesce(value < before, true) as is_new_best
from r""")
def running_best(spark, sf):
    return S.running_best(X.metrics(spark, sf))


@query("peak_and_final", f"""with {M}
select run, max(case when tag = 'train/learning_rate' then value end) as peak_learning_rate,
  max(case when tag = 'train/learning_rate' and down = 1 then value end) as final_learning_rate,
  max(case when tag = 'train/epoch' and down = 1 then value end) as final_epoch
from a where tag in ('train/learning_rate', 'train/epoch') group by run""")
def peak_and_final(spark, sf):
    return A.peak_and_final(X.metrics(spark, sf))


@query("best_run", f"""with {M}
select run, min(value) as best_value from k where tag = 'eval/loss' group by run""")
def best_run(spark, sf):
    return A.best_run(X.metrics(spark, sf))


_THROUGHPUT = """th as (
  select run, max(wall_time) - min(wall_time) as seconds, max(step) as steps from k group by run)"""


@query("run_throughput", f"""with {M}, {_THROUGHPUT}
select run, round(seconds, 3) as seconds, steps, round(seconds / 3600, 6) as hours,
  round(22500 / seconds, 6) as samples_per_second, round(steps / seconds, 6) as steps_per_second
from th""")
def run_throughput(spark, sf):
    out = A.run_throughput(_kept(spark, sf), 4500, 5)
    return _rounded(out, "hours", "samples_per_second", "steps_per_second").withColumn(
        "seconds", F.round("seconds", 3)
    )


@query("run_cost", f"""with {M}, {_THROUGHPUT}
select run, round(seconds / 3600, 6) as hours, round(seconds / 3600 * 0.7512, 6) as cost,
  round(0.7512 * 24, 6)::double as daily_cost, round(0.7512 * 24 * 30, 6)::double as monthly_cost
from th""")
def run_cost(spark, sf):
    speed = A.run_throughput(_kept(spark, sf), 4500, 5)
    return _rounded(A.run_cost(speed, 0.7512), "hours", "cost", "daily_cost", "monthly_cost")


@query("merge_metric_sources", f"""with {M}, r as (
  select run, tag, step, value,
    row_number() over (partition by run, tag, step order by (ord % 3 = 1) desc, ord) as n
  from k)
select run, tag, step, value from r where n = 1""")
def merge_sources(spark, sf):
    kept = _kept(spark, sf)
    first, second = kept.filter("ord % 3 = 1"), kept.filter("ord % 3 <> 1")
    return S.first_per_step(merge_metric_sources(first, second)).drop("wall_time", "ord")


def _states(spark, sf):
    states = X.trainer_states(spark, sf).select(
        "run", "segment", F.from_json("document", TRAINER_STATE_SCHEMA).alias("state")
    )
    return states.select("run", "segment", "state.*")


@query("trainer_state_explode", f"""with {M}
select run, ord // 100 as segment, tag, step, value,
  row_number() over (partition by run, ord // 100 order by ord) - 1 as ord
from m where tag in ('train/loss', 'eval/loss')""")
def trainer_history(spark, sf):
    return explode_trainer_state(_states(spark, sf), ["run", "segment"])


@query("trainer_state_header", f"""with {M}
select run, ord // 100 as segment, min(case when tag = 'eval/loss' then value end) as best_metric,
  null::varchar as best_model_checkpoint, max(step) as global_step, null::double as epoch
from m where tag in ('train/loss', 'eval/loss') group by run, ord // 100""")
def trainer_header(spark, sf):
    return trainer_state_header(_states(spark, sf), ["run", "segment"])


@query("trainer_state_files", f"""with {M},
s as (select *, ord // 100 as segment, row_number() over (partition by run, ord // 100 order by ord) - 1 as place
  from m where tag in ('train/loss', 'eval/loss')),
b as (select run, segment, lag(150 * (segment + 1)) over (partition by run order by segment) as before
  from (select distinct run, segment from s))
select s.run, tag, step, value, place as ord
from s join b on s.run = b.run and s.segment = b.segment where before is null or step > before""")
def state_files(spark, sf):
    folder = new_folder(spark, "states")
    X.state_files(spark, sf, folder)
    _, found = read_trainer_state(spark, folder)
    return found.drop("wall_time")


_CONSOLE = """
select run, ord, step, tag, value from m where tag in ('train/loss', 'eval/loss')
union all
select run, ord, step, 'train/learning_rate' as tag, 1.5e-04::double as value from m where tag = 'train/loss'"""


@query("console_metrics", f"with {M} {_CONSOLE}")
def console_metrics(spark, sf):
    lines = X.console_lines_of(X.table(spark, sf, "events"))
    return parse_console_metrics(lines, "line", ["run", "ord"])


@query("metrics_map_explode", """
select event_id, user_id as step, unnest(json_keys(props)) as tag,
  json_extract(props, '$.' || unnest(json_keys(props)))::double as value
from events""")
def metrics_map_explode(spark, sf):
    rows = X.table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("step"),
        F.from_json("props", "map<string, double>").alias("metrics"),
    )
    return explode_metrics_map(rows, ["event_id", "step"])


@query("console_summary", f"""with {M}
select run, 'train/loss' as tag, min(value) as min_value, max(value) as max_value
from m where tag = 'train/loss' group by run
union all select run, 'eval/loss', min(value), max(value) from m where tag = 'eval/loss' group by run
union all select run, 'train/learning_rate', 1.5e-04::double, 1.5e-04::double
from m where tag = 'train/loss' group by run""")
def console_summary(spark, sf):
    lines = X.console_lines_of(X.table(spark, sf, "events"))
    found, _ = read_console_metrics(lines, "line", "run", "ord")
    return A.summarise_metrics(found).select("run", "tag", "min_value", "max_value")


@query("console_rejects", f"""with {M}
select run, 'no_record' as reason, count(*) as lines from m
where tag not in ('train/loss', 'eval/loss') group by run""")
def rejected_lines(spark, sf):
    lines = X.console_lines_of(X.table(spark, sf, "events"))
    _, rejects = read_console_metrics(lines, "line", "run", "ord")
    return rejects.groupBy("run", "reason").agg(F.count(F.lit(1)).alias("lines"))

