"""Queries over logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.checks import fixtures as X
from tunelake.checks.registry import query
from tunelake.operators import logs as L
from tunelake.session import new_folder
from tunelake.sources.logs import read_app_log

LOG = """
lg as (
  select event_id, ts, event_type, value,
    case when event_type = 'error' then 'ERROR - Training failed: ' || event_id
      else '{''loss'': ' || value || ', ''step'': ' || event_id || '}' end as message
  from events)
"""
_MINUTE = "yyyy-MM-dd HH:mm:ss"
_STAMP = "'%Y-%m-%d %H:%M:%S'"


@query("app_log_parse", f"""with {LOG}
select event_id % 13 <> 5 as parsed,
  case when event_id % 13 <> 5 then strftime(ts, {_STAMP}) end as logged_at,
  case when event_id % 13 <> 5 then case when event_type = 'error' then 'ERROR' else 'INFO' end end as level,
  case when event_id % 13 <> 5 then 'tuner.train' end as name,
  case when event_id % 13 <> 5 then 'main' end as function,
  case when event_id % 13 <> 5 then (event_id % 600)::int end as line_no,
  case when event_id % 13 <> 5 then message else '    raise ValueError | x' end as message
from lg""")
def app_log(spark, sf):
    folder = new_folder(spark, "log")
    X.log(spark, sf).select("value").write.option("compression", "gzip").text(folder)
    return read_app_log(spark, folder).withColumn("logged_at", F.date_format("logged_at", _MINUTE))


@query("search_log", f"""with {LOG}
select event_id, message from lg
where contains(message, 'failed') and ts >= timestamp '2024-01-03 00:00:00'""")
def search(spark, sf):
    since = F.expr("timestamp_ntz'2024-01-03 00:00:00'")
    return L.search_log(X.log(spark, sf), "failed", since).select("event_id", "message")


@query("extract_loss", f"""with {LOG}
select event_id, value as loss from lg where contains(message, 'loss')""")
def loss(spark, sf):
    return L.extract_loss(X.log(spark, sf)).select("event_id", "loss")


@query("errors_per_5m", f"""with {LOG}, b as (
  select time_bucket(interval 5 minute, ts) as bin, count(*) as errors
  from lg where contains(message, 'ERROR') group by 1)
select strftime(bin, {_STAMP}) as bin_start, strftime(bin + interval 5 minute, {_STAMP}) as bin_end, errors
from b""")
def errors(spark, sf):
    return L.error_rate(X.log(spark, sf)).withColumns(
        {c: F.date_format(c, _MINUTE) for c in ("bin_start", "bin_end")}
    )
