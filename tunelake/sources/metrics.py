"""Run metrics as one long table: ``run, tag, step, value, wall_time, ord``.

``ord`` is the place of a row in what was read; within a run and tag it is unique and settles which
of several values for one step came first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.operators.ranking import rank_in_groups
from tunelake.session import written
from tunelake.sources.documents import read_documents

METRICS_SCHEMA = "run string, tag string, step bigint, value double, wall_time double, ord bigint"

HISTORY_TAGS = {
    "loss": "train/loss",
    "eval_loss": "eval/loss",
    "learning_rate": "train/learning_rate",
    "epoch": "train/epoch",
    "eval_runtime": "eval/runtime",
}

_HISTORY_ROW = (
    "struct<epoch: double, learning_rate: double, loss: double, eval_loss: double, "
    "eval_runtime: double, step: bigint>"
)
TRAINER_STATE_SCHEMA = (
    "best_metric double, best_model_checkpoint string, epoch double, global_step bigint, "
    f"total_flos double, train_batch_size int, log_history array<{_HISTORY_ROW}>"
)
def read_metric_events(
    spark: SparkSession,
    path: str | list[str],
    format: str = "parquet",
    places_of_file: bool = False,
) -> DataFrame:
    """All metric files under the folder, at any depth, as one long table.

    ``ord`` is taken from the files. With ``places_of_file`` it holds within one file only, as where
    several writers each counted from 0; it is then numbered anew, file by file in order of name, and
    the rows are written once to the shared folder.
    """
    events = (
        spark.read.schema(METRICS_SCHEMA)
        .option("recursiveFileLookup", "true")
        .format(format)
        .load(path)
    )
    if not places_of_file:
        return events
    columns = events.columns
    events = events.withColumn("_file", F.col("_metadata.file_path")).withColumnRenamed("ord", "_ord")
    ranked = rank_in_groups(events, ["run", "tag"], ["_file", "_ord"], "ord")
    return ranked.withColumn("ord", F.col("ord") - 1).select(*columns)


def _long(rows: DataFrame, keep: list[str], columns: dict[str, str]) -> DataFrame:
    """Turn sparse metric columns into ``tag, value`` rows; empty cells give no row."""
    cells = F.array(
        *[
            F.struct(F.lit(tag).alias("tag"), F.col(column).alias("value"))
            for column, tag in columns.items()
        ]
    )
    return (
        rows.select(*keep, F.inline(F.filter(cells, lambda c: c["value"].isNotNull())))
    )


def explode_trainer_state(states: DataFrame, keys: list[str]) -> DataFrame:
    """History rows of parsed trainer states as long metrics: ``keys, step, ord, tag, value``."""
    rows = states.select(*keys, F.posexplode("log_history").alias("pos", "row")).select(
        *keys, F.col("pos").cast("bigint").alias("ord"), "row.*"
    )
    return _long(rows, [*keys, "step", "ord"], HISTORY_TAGS)


def trainer_state_header(states: DataFrame, keys: list[str]) -> DataFrame:
    """The header fields of parsed trainer states, one row for each."""
    return states.select(
        *keys, "best_metric", "best_model_checkpoint", "global_step", "epoch"
    )


def read_trainer_state(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Trainer-state documents: ``(headers, metrics)``.

    ``run`` is the folder above ``checkpoint-N``, or the document's own folder where it lies in none.
    The metrics have the columns of all metric sources, without wall times. Every checkpoint of a run
    holds the whole history so far; of each only the steps after the checkpoint before are taken. Every
    file is opened once: the parsed states are written to the shared folder. No list of files is held by the
    driver where the files are local or mounted (``read_documents``).
    """
    file = F.col("_file")
    states = (
        read_documents(spark, path, "trainer_state.json", TRAINER_STATE_SCHEMA)
        .withColumn("folder", F.regexp_replace(file, r"/[^/]*$", ""))
        .withColumn("run", F.regexp_extract(file, r"/([^/]+?)(?:/checkpoint-[0-9]+)?/[^/]*$", 1))
        .withColumn(
            "_number",
            F.coalesce(
                F.try_to_number(F.regexp_extract(file, r"/checkpoint-([0-9]+)/[^/]*$", 1), F.lit("9" * 18)),
                F.col("global_step"),
            ).cast("bigint"),
        )
        .drop("_file")
    )
    states = written(states, "states")
    headers = trainer_state_header(states, ["run", "folder"])
    # One row for each checkpoint of a run. Names pack so well that these look small enough to broadcast.
    before = Window.partitionBy("run").orderBy("_number", "folder")
    starts = states.select("run", "folder", "_number").select(
        F.col("folder").alias("_folder"), F.lag("_number").over(before).alias("_from")
    )
    metrics = (
        explode_trainer_state(
            states.join(starts.hint("merge"), F.col("folder") == F.col("_folder")), ["run", "folder", "_from"]
        )
        .filter(F.col("_from").isNull() | (F.col("step") > F.col("_from")))
        .select("run", "tag", "step", "value", F.lit(None).cast("double").alias("wall_time"), "ord")
    )
    return headers, metrics


def _console_records(lines: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """``keep``, the line, ``_values`` by name, and the ``reason`` why it is no metric, if it is none."""
    text = F.col(line)
    seal = F.xxhash64(text).cast("string")
    wrapped = F.concat(F.lit('{"v":['), text, F.lit('],"seal":"'), seal, F.lit('"}'))
    parsed = F.from_json(wrapped, "v array<map<string, double>>, seal string")
    whole = (F.size(F.col("_p.v")) == 1) & (F.col("_p.seal") == seal)
    return (
        lines.select(*keep, text, parsed.alias("_p"))
        .withColumn("_values", F.when(whole, F.get("_p.v", F.lit(0))))
        .withColumn(
            "reason",
            F.when(F.col("_values").isNull(), "no_record").when(F.col("_values")["step"].isNull(), "no_step"),
        )
        .drop("_p")
    )


def parse_console_metrics(lines: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """Console lines such as ``{'loss': 2.8, 'step': 10}`` as long metrics: ``keep, step, tag, value``.

    Every number in the record but the step gives a row; names without a tag of their own are the tag.
    Lines that are not exactly one such record, or have no step, are ``console_rejects``.
    """
    tags = F.create_map(*(F.lit(x) for pair in HISTORY_TAGS.items() for x in pair))
    records = _console_records(lines, line, keep).filter(F.col("reason").isNull())
    cells = records.select(
        *keep, F.col("_values")["step"].cast("bigint").alias("step"), F.explode("_values").alias("_name", "value")
    )
    return cells.filter((F.col("_name") != "step") & F.col("value").isNotNull()).select(
        *keep, "step", F.coalesce(tags[F.col("_name")], "_name").alias("tag"), "value"
    )


def console_rejects(lines: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """The lines that give no metric, with the reason: ``no_record`` or ``no_step``."""
    return _console_records(lines, line, keep).filter(F.col("reason").isNotNull()).drop("_values")


def read_console_metrics(
    lines: DataFrame, line: str, run: str, place: str
) -> tuple[DataFrame, DataFrame]:
    """``(metrics, rejects)`` of console lines with their run and place, in the shape of all sources."""
    metrics = parse_console_metrics(lines, line, [run, place]).select(
        F.col(run).alias("run"), "tag", "step", "value", F.lit(None).cast("double").alias("wall_time"),
        F.col(place).cast("bigint").alias("ord"),
    )
    return metrics, console_rejects(lines, line, [run, place])


def explode_metrics_map(log: DataFrame, keep: list[str], metrics: str = "metrics") -> DataFrame:
    """An open map of metrics on a log row as one row for each entry."""
    return log.select(*keep, F.explode(metrics).alias("tag", "value"))


def merge_metric_sources(*sources: DataFrame) -> DataFrame:
    """Several event files of one run as one series; rows of an earlier source come first.

    ``ord`` is numbered anew in each run and tag, by source and then by the place in it, for any
    number of sources and any places. The merged rows are written once to the shared folder.
    """
    if not sources:
        raise ValueError("no source given")
    numbered = [df.withColumn("_source", F.lit(number)) for number, df in enumerate(sources)]
    merged = numbered[0]
    for df in numbered[1:]:
        merged = merged.unionByName(df)
    places = merged.withColumnRenamed("ord", "_ord")
    ranked = rank_in_groups(places, ["run", "tag"], ["_source", "_ord"], "ord")
    return ranked.withColumn("ord", F.col("ord") - 1).select(*sources[0].columns)
