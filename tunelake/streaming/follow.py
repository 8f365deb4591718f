"""File-source streams, the streamed forms of the log and metric operators, and resuming.

No server and no port: a stream follows the files of a folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tunelake.constants import EVAL_LOSS, TRAIN_LOSS
from tunelake.operators.logs import error_rate, search_log
from tunelake.session import written
from tunelake.sources.metrics import parse_console_metrics


def follow_log(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files of a folder as they arrive (column ``value``).

    For files that are written once; ``tail.tail_log`` follows files that grow.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def follow_table(
    spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """Rows of a Parquet folder, or of one Parquet file, as files arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # The source takes a single file only by pattern; this pattern matches the path itself.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def stream_metrics(lines: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """Console metric lines as long metrics, row by row."""
    return parse_console_metrics(lines, line, keep)


def stream_errors(
    log: DataFrame,
    every: str = "5 minutes",
    late_by: str = "10 minutes",
    term: str = "ERROR",
    message: str = "message",
    time: str = "ts",
) -> DataFrame:
    """Errors per time bin; a bin is final once an error ``late_by`` after its end was seen.

    Rows that come later than that are dropped. The watermark follows the matching rows. Times
    without a zone are read in the session's zone, as watermarks need one.
    """
    found = (
        search_log(log, term, message=message)
        .withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, late_by)
    )
    return error_rate(found, every, term, message, time)


def run_state(metrics: DataFrame) -> DataFrame:
    """Where each run stands: last step, latest training loss, best evaluation loss.

    The same function serves a table and a stream. A table is aggregated by step first, so that plain
    numbers order both levels; a stream, which takes one level, orders by a pair and keeps one row of
    state for each run for ever. ``follow_run_state`` needs no such state.
    """
    if not metrics.isStreaming:
        return _state_of(_step_state(metrics))
    place = F.struct("step", "ord")
    return metrics.groupBy("run").agg(
        F.max("step").alias("global_step"),
        F.max_by("value", F.when(F.col("tag") == TRAIN_LOSS, place)).alias("train_loss"),
        F.min(F.when(F.col("tag") == EVAL_LOSS, F.col("value"))).alias("best_metric"),
    )


def _step_state(metrics: DataFrame) -> DataFrame:
    """A row for each run and step: its latest training loss with the place, its best evaluation loss."""
    train = F.col("tag") == TRAIN_LOSS
    return metrics.groupBy("run", "step").agg(
        F.max(F.when(train, F.col("ord"))).alias("ord"),
        F.max_by("value", F.when(train, F.col("ord"))).alias("value"),
        F.min(F.when(F.col("tag") == EVAL_LOSS, F.col("value"))).alias("best"),
    )


def _state_of(steps: DataFrame, *more: str) -> DataFrame:
    """A row for each run of such rows."""
    trained = F.when(F.col("ord").isNotNull(), F.col("step"))
    places = {"train_step": F.max(trained), "train_ord": F.max_by("ord", trained)}
    return steps.groupBy("run").agg(
        F.max("step").alias("global_step"),
        F.max_by("value", trained).alias("train_loss"),
        F.min("best").alias("best_metric"),
        *(places[name].alias(name) for name in more),
    )


def _numbers(spark: SparkSession, base: str, prefix: str) -> list[int]:
    """Numbers of the folders under ``base`` whose names begin with ``prefix``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def move(spark: SparkSession, path: str, target: str) -> None:
    """Move a file, for instance a log that makes room for a new one."""
    here, there = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    here.getFileSystem(spark._jsc.hadoopConfiguration()).rename(here, there)


def attempt_folder(spark: SparkSession, base: str, resume: bool = True) -> str:
    """The folder in which a stream keeps its state and output.

    Resuming takes the highest numbered attempt; starting fresh takes the next number and leaves the
    earlier ones as they are.
    """
    numbers = _numbers(spark, base, "attempt-")
    latest = numbers[-1] if numbers else 0
    number = latest if resume and numbers else latest + 1
    return f"{base.rstrip('/')}/attempt-{number}"


def append_available(stream: DataFrame, folder: str) -> DataFrame:
    """Process what is there now, append final rows to ``folder/output`` and read all of it.

    Progress is kept in ``folder/state``: a second call takes up only what is new.
    """
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/output")
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/output")


def update_available(stream: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """Process what is there now in update mode and give the latest row of every key.

    Each micro-batch folds its changed rows into the table of the batch before and writes the whole,
    one row for each key, to a folder of its own number; so a batch run again after a failure replaces
    its own table only, and readers take the newest. Tables before the last two are removed.
    """
    spark = stream.sparkSession
    output = f"{folder}/output"

    def table(number: int, name: str = "batch") -> DataFrame:
        return spark.read.schema(stream.schema).parquet(f"{output}/{name}={number}")

    def remove(number: int, name: str = "batch") -> None:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{output}/{name}={number}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def save(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{output}/changed={number}")
        rows = table(number, "changed")
        earlier = [n for n in _numbers(spark, output, "batch=") if n < number]
        folded = rows
        if earlier:
            before, changed = table(earlier[-1]), rows.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = F.lit(True)
            for key in keys:
                same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
            folded = before.join(changed, same, "left_anti").unionByName(rows)
        folded.write.mode("overwrite").parquet(f"{output}/batch={number}")
        remove(number, "changed")
        for old in earlier[:-1]:
            remove(old)

    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    numbers = _numbers(spark, output, "batch=")
    if not numbers:
        return spark.createDataFrame([], stream.schema)
    return table(numbers[-1])


def _fold(
    stream: DataFrame, folder: str, fold: Callable[[DataFrame, DataFrame | None, int], dict[str, DataFrame]]
) -> None:
    """Process what is there now; ``fold`` makes the tables of a micro-batch from its rows and the ``kept`` before.

    Tables go to ``folder/<name>/batch=<number>``, so a batch that runs again replaces its own only. Of
    ``kept`` the last two are left, of others all.
    """
    spark = stream.sparkSession

    def save(rows: DataFrame, number: int) -> None:
        earlier = [n for n in _numbers(spark, f"{folder}/kept", "batch=") if n < number]
        before = spark.read.parquet(f"{folder}/kept/batch={earlier[-1]}") if earlier else None
        for name, table in fold(rows, before, number).items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        for old in earlier[:-1]:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/kept/batch={old}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _latest(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The newest ``kept`` table of ``_fold``."""
    numbers = _numbers(spark, f"{folder}/kept", "batch=")
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/kept/batch={numbers[-1]}")


def follow_run_state(metrics: DataFrame, folder: str) -> DataFrame:
    """``run_state`` of a stream of metrics, without streaming state.

    A micro-batch is aggregated as a table is, with partial sums, and folded into the table of the batch
    before, which has one row for each run; it keeps the place of the latest training loss as plain
    numbers. Nothing else outlives a batch, however many runs there have been, and a run that goes on
    after any time goes on right.
    """

    def fold(rows: DataFrame, before: DataFrame | None, number: int) -> dict[str, DataFrame]:
        steps = _step_state(rows)
        if before is not None:
            known = before.filter("train_step is not null").select(
                "run", F.col("train_step").alias("step"), F.col("train_ord").alias("ord"),
                F.col("train_loss").alias("value"), F.lit(None).cast("double").alias("best"),
            )
            last = before.select(
                "run", F.col("global_step").alias("step"), F.lit(None).cast("long").alias("ord"),
                F.lit(None).cast("double").alias("value"), F.col("best_metric").alias("best"),
            )
            both = steps.unionByName(known).unionByName(last)
            steps = both.groupBy("run", "step").agg(
                F.max("ord").alias("ord"), F.max_by("value", "ord").alias("value"), F.min("best").alias("best")
            )
        return {"kept": _state_of(steps, "train_step", "train_ord")}

    _fold(metrics, folder, fold)
    schema = "run string, global_step long, train_loss double, best_metric double"
    return _latest(metrics.sparkSession, folder, schema)


def follow_errors(
    log: DataFrame,
    folder: str,
    every: str = "5 minutes",
    late_by: str = "10 minutes",
    term: str = "ERROR",
    message: str = "message",
    time: str = "ts",
) -> DataFrame:
    """Errors per time bin with what happens to each bin: ``bin_start, bin_end, errors, kind``.

    ``stream_errors`` gives bins when they are final and drops what comes later. Here open bins are there
    too, as ``provisional``, and errors that come after their bin became ``final`` are counted as
    ``late`` for it, so the three kinds together count every error. A bin is final once an error
    ``late_by`` after its end was in an earlier micro-batch or the same one; only open bins outlive a batch.
    """
    spark = log.sparkSession
    found = search_log(log, term, message=message).withColumn(time, F.col(time).cast("timestamp"))

    def fold(rows: DataFrame, before: DataFrame | None, number: int) -> dict[str, DataFrame]:
        bins = rows.groupBy(F.window(time, every).alias("w")).agg(
            F.count(F.lit(1)).alias("errors"), F.max(time).alias("seen")
        )
        bins = bins.select(F.col("w.start").alias("bin_start"), F.col("w.end").alias("bin_end"), "errors", "seen")
        until = before.agg(F.max("seen")).first()[0] if before is not None else None
        passed = F.lit(until).cast("timestamp") - F.expr(f"interval {late_by}")
        is_late = F.coalesce(F.col("bin_end") <= passed, F.lit(False))
        # The row without a bin holds the latest time seen once its bin has gone.
        opened = bins.filter(~is_late)
        if before is not None:
            opened = opened.unionByName(before)
        opened = written(
            opened.groupBy("bin_start", "bin_end").agg(F.sum("errors").alias("errors"), F.max("seen").alias("seen")),
            "bins",
        )
        latest = opened.agg(F.max("seen")).first()[0]
        now = F.lit(latest).cast("timestamp") - F.expr(f"interval {late_by}")
        closed = F.coalesce(F.col("bin_end") <= now, F.lit(False))
        marker = opened.agg(F.max("seen").alias("seen")).select(
            F.lit(None).cast("timestamp").alias("bin_start"), F.lit(None).cast("timestamp").alias("bin_end"),
            F.lit(0).cast("long").alias("errors"), "seen",
        )
        counts = ["bin_start", "bin_end", "errors"]
        return {
            "final": opened.filter(closed & F.col("bin_start").isNotNull()).select(*counts),
            "late": bins.filter(is_late).select(*counts),
            "kept": opened.filter(~closed & F.col("bin_start").isNotNull()).unionByName(marker),
        }

    _fold(found, folder, fold)
    schema = "bin_start timestamp, bin_end timestamp, errors long"

    def every_batch(name: str, kind: str) -> DataFrame:
        numbers = _numbers(spark, f"{folder}/{name}", "batch=")
        rows = (
            spark.read.schema(schema).parquet(*(f"{folder}/{name}/batch={n}" for n in numbers))
            if numbers else spark.createDataFrame([], schema)
        )
        return rows.groupBy("bin_start", "bin_end").agg(F.sum("errors").alias("errors")).withColumn("kind", F.lit(kind))

    provisional = _latest(spark, folder, schema).filter("bin_start is not null").withColumn("kind", F.lit("provisional"))
    return every_batch("final", "final").unionByName(provisional).unionByName(every_batch("late", "late"))
