"""Queries that run a stream over everything there is, and stop."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.checks import fixtures as X
from tunelake.checks.logs import LOG
from tunelake.checks.metrics import _CONSOLE, M
from tunelake.checks.registry import query
from tunelake.session import new_folder
from tunelake.streaming import follow as S
from tunelake.streaming.tail import tail_log

_MINUTE = "yyyy-MM-dd HH:mm:ss"
_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _events(spark, sf):
    return S.follow_table(spark, f"{sf}/events.parquet", X.table(spark, sf, "events").schema)


@query("stream_follow", f"with {LOG} select message as value from lg")
def follow(spark, sf):
    folder = new_folder(spark, "lines")
    X.log(spark, sf).select(F.col("message").alias("value")).write.text(folder)
    return S.append_available(S.follow_log(spark, folder), new_folder(spark, "follow"))


@query("stream_tail", f"with {LOG} select message as value from lg")
def tail(spark, sf):
    """Log files grow, one is moved aside with unread lines, and the stream starts anew each time."""
    folder, base = new_folder(spark, "growing"), new_folder(spark, "tail")
    messages = X.log(spark, sf).select("event_id", F.col("message").alias("value"))
    for turn in range(3):
        X.append_lines(messages.filter(F.col("event_id") % 3 == turn).select("value"), folder, 4)
        if turn == 1:
            S.move(spark, f"{folder}/app-0.log", f"{folder}/app-0.log.1")
        out = S.append_available(tail_log(spark, folder), base)
    return out.select("value")


@query("stream_metrics", f"with {M} {_CONSOLE}")
def metrics(spark, sf):
    lines = X.console_lines_of(_events(spark, sf))
    return S.append_available(
        S.stream_metrics(lines, "line", ["run", "ord"]), new_folder(spark, "metrics")
    )


@query("stream_errors_5m", f"""with {LOG}, er as (select * from lg where contains(message, 'ERROR')),
b as (select time_bucket(interval 5 minute, ts) as bin, count(*) as errors from er group by 1)
select strftime(bin, {_STAMP}) as bin_start, strftime(bin + interval 5 minute, {_STAMP}) as bin_end, errors
from b where bin + interval 5 minute <= (select max(ts) from er) - interval 10 minute""")
def errors(spark, sf):
    counts = S.stream_errors(X.log_of(_events(spark, sf)))
    return S.append_available(counts, new_folder(spark, "errors")).withColumns(
        {c: F.date_format(c, _MINUTE) for c in ("bin_start", "bin_end")}
    )


@query("stream_error_kinds", f"""with {LOG},
er as (select time_bucket(interval 5 minute, ts) + interval 5 minute as bin_end, ts, event_id % 2 as turn
  from lg where contains(message, 'ERROR')),
passed as (select (select max(ts) from er where turn = 0) - interval 10 minute as first,
  (select max(ts) from er) - interval 10 minute as last),
k as (select bin_end, case when turn = 1 and bin_end <= first then 'late'
    when bin_end <= last then 'final' else 'provisional' end as kind from er, passed)
select strftime(bin_end - interval 5 minute, {_STAMP}) as bin_start, strftime(bin_end, {_STAMP}) as bin_end,
  count(*) as errors, kind from k group by all""")
def error_kinds(spark, sf):
    """Every second row of the log comes when the first ones have closed most bins."""
    incoming, folder = new_folder(spark, "incoming"), new_folder(spark, "kinds")
    rows = X.log(spark, sf).select("event_id", "ts", "message")
    for turn in range(2):
        rows.filter(F.col("event_id") % 2 == turn).write.mode("append").parquet(incoming)
        bins = S.follow_errors(S.follow_table(spark, incoming, rows.schema), folder)
    return bins.withColumns({c: F.date_format(c, _MINUTE) for c in ("bin_start", "bin_end")})


@query("stream_run_state", f"""with {M}
select run, max(step) as global_step,
  max(case when tag = 'train/loss' and down = 1 then value end) as train_loss,
  min(case when tag = 'eval/loss' then value end) as best_metric
from a group by run""")
def state(spark, sf):
    kept = X.metrics_of(_events(spark, sf)).filter("tag <> 'train/grad_norm'")
    return S.follow_run_state(kept, new_folder(spark, "state"))


@query("stream_resume", f"with {M} select run, tag, step, value, ord from m")
def resume(spark, sf):
    """Half of the rows arrive, the stream stops, the rest arrives, the stream goes on."""
    incoming, base = new_folder(spark, "incoming"), new_folder(spark, "resume")
    rows = X.metrics(spark, sf).drop("wall_time")
    for late in (False, True):
        rows.filter((F.col("ord") % 2 == 1) == F.lit(late)).write.mode("append").parquet(incoming)
        out = S.append_available(
            S.follow_table(spark, incoming, rows.schema), S.attempt_folder(spark, base)
        )
    return out
