"""Test inputs: the shapes the operators read, derived row by row from the given tables.

No derivation but ``trainer_states`` and ``checkpoints`` shuffles, so a query's cost is mostly the
operator's own and grows with its table.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.constants import ASSISTANT_MARKER, INFERENCE_INSTRUCTION, RECORD_FIELDS
from tunelake.functions.strict_json import dumps_record

BASE = "models/extractor"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def metrics_of(events: DataFrame) -> DataFrame:
    """Five runs; tags by event type; some training steps jump back, as after a resumed run."""
    tags = {
        "click": "train/loss",
        "view": "eval/loss",
        "signup": "train/learning_rate",
        "purchase": "train/epoch",
        "error": "train/grad_norm",
    }
    tag = F.lit(None).cast("string")
    for kind, name in tags.items():
        tag = F.when(F.col("event_type") == kind, name).otherwise(tag)
    eid = F.col("event_id")
    step = F.when(F.col("event_type") == "view", 15 * F.expr("event_id div 10")).otherwise(
        10 * F.greatest(F.lit(0), F.expr("event_id div 8") - F.when(eid % 17 == 0, 3).otherwise(0))
    )
    seconds = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1e6
    return events.select(
        F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("run"),
        tag.alias("tag"),
        step.cast("bigint").alias("step"),
        "value",
        seconds.alias("wall_time"),
        eid.alias("ord"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_of(table(spark, sf_dir, "events"))


def record_of_part() -> Column:
    """The seven fields from a row of ``part``."""
    key = F.col("p_partkey")
    values = {
        "cancer_type": F.col("p_type"),
        "stage": F.col("p_size").cast("string"),
        "gene_mutation": F.when(key % 3 != 0, F.col("p_brand")),
        "biomarker": F.when(key % 5 != 0, F.concat("p_brand", F.lit("; "), "p_type")),
        "treatment": F.col("p_name"),
        "response": F.when(key % 7 != 0, F.lit('stable "disease"')),
        "metastasis_site": F.when(key % 2 != 0, F.lit("brain, liver")),
    }
    return F.struct(*[values[f].alias(f) for f in RECORD_FIELDS])


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, instruction, input, output, split``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.lit(INFERENCE_INSTRUCTION).alias("instruction"),
        F.col("p_name").alias("input"),
        record_of_part().alias("output"),
        F.when(F.col("p_partkey") % 10 == 0, "validation").otherwise("train").alias("split"),
    )


def example_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, value``: JSON lines of ``part``; the remainder of the key by 11 picks a defect."""
    head = F.concat(
        F.lit('{"instruction": "' + INFERENCE_INSTRUCTION + '", "input": "'), "p_name", F.lit('"')
    )
    defect = F.col("p_partkey") % 11
    good = F.col("good")
    return (
        table(spark, sf_dir, "part")
        .withColumn("head", head)
        .withColumn(
            "good", F.concat("head", F.lit(', "output": '), dumps_record(record_of_part()), F.lit("}"))
        )
        .select(
            F.col("p_partkey").alias("id"),
            F.when(defect == 1, " ")
            .when(defect == 2, "{bad")
            .when(defect == 3, "[1]")
            .when(defect == 4, F.concat("head", F.lit("}")))
            .when(defect == 5, F.concat(good, F.lit(" trailing")))
            .when(defect == 6, F.concat(F.lit("  "), good, F.lit("\t")))
            .otherwise(good)
            .alias("value"),
        )
    )


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, expected_json``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), dumps_record(record_of_part()).alias("expected_json")
    )


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, predicted_json``: the expected record changed by the remainder of the key by 11."""
    rule = F.col("p_partkey") % 11
    changed = (
        record_of_part()
        .withField("stage", F.when(rule == 1, "changed").otherwise(F.col("p_size").cast("string")))
        .withField("response", F.when((rule != 2) & (F.col("p_partkey") % 7 != 0), 'stable "disease"'))
    )
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), rule.alias("rule"), changed.alias("record")
    )
    whole = F.col("whole")
    return rows.withColumn("whole", dumps_record(F.col("record"))).select(
        "id",
        F.when(F.col("rule") == 3, F.concat(F.lit('{"other": 1, '), F.substr(whole, F.lit(2))))
        .when(F.col("rule") == 4, dumps_record(F.col("record"), RECORD_FIELDS[:-1]))
        .when(F.col("rule") == 5, dumps_record(F.col("record"), RECORD_FIELDS[::-1]))
        .when(F.col("rule") == 6, F.lit(None).cast("string"))
        .when(F.col("rule") == 7, F.concat(F.lit("Answer: "), whole))
        .otherwise(whole)
        .alias("predicted_json"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, generated``: assistant turns with a JSON block added by rule."""
    block = F.concat(
        F.lit('{"cancer_type": "c'), F.col("conv_id").cast("string"),
        F.lit('", "stage": null}'),
    )
    broken = F.concat(
        F.lit('{"cancer_type": "c'), F.col("conv_id").cast("string"),
        F.lit('",\n "stage": null}'),
    )
    rule = (F.col("conv_id") + F.col("turn")) % 8
    return (
        table(spark, sf_dir, "conversations")
        .filter(F.col("role") == "assistant")
        .select(
            "conv_id",
            "turn",
            F.when(rule == 0, block)
            .when(rule == 1, F.concat("text", F.lit(" "), block, F.lit(" "), "text"))
            .when(rule == 2, F.concat("text", F.lit("\n"), broken))
            .when(rule == 3, F.col("text"))
            .when(rule == 4, F.concat("text", F.lit("} {")))
            .when(rule == 5, F.concat(F.lit("{}"), "text"))
            .when(rule == 6, F.concat(F.lit('{"a":1} x {"b":2}'), "text"))
            .otherwise(F.concat(F.lit("{'cancer_type': 'x'}"), "text"))
            .alias("generated"),
        )
    )


def chat_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, full_text``: texts with no, one or two assistant marks."""
    rule = F.col("turn") % 3
    mark = F.lit(ASSISTANT_MARKER)
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(rule == 0, F.concat(F.lit(" "), "text", F.lit("\n")))
        .when(rule == 1, F.concat(F.lit("first"), mark, F.lit("\n\n"), "text", F.lit("\t ")))
        .otherwise(F.concat(F.lit("first"), mark, F.lit(" draft "), mark, F.lit(" \n"), "text"))
        .alias("full_text"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts, value`` (whole line)."""
    return log_of(table(spark, sf_dir, "events"))


def log_of(events: DataFrame) -> DataFrame:
    """``event_id, ts, message, value``: log messages and whole log lines; some lines go on below."""
    message = F.when(
        F.col("event_type") == "error",
        F.concat(F.lit("ERROR - Training failed: "), F.col("event_id").cast("string")),
    ).otherwise(
        F.concat(
            F.lit("{'loss': "), F.col("value").cast("string"),
            F.lit(", 'step': "), F.col("event_id").cast("string"), F.lit("}"),
        )
    )
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" | "), F.rpad(level, 8, " "),
        F.lit(" | tuner.train:main:"), (F.col("event_id") % 600).cast("string"),
        F.lit(" - "), message,
    )
    return events.select(
        "event_id",
        "ts",
        message.alias("message"),
        F.when(F.col("event_id") % 13 == 5, F.lit("    raise ValueError | x"))
        .otherwise(line)
        .alias("value"),
    )


def console_lines_of(events: DataFrame) -> DataFrame:
    """``run, ord, line``: printed metric dictionaries, and lines that are none."""
    m = metrics_of(events)
    value, step = F.col("value").cast("string"), F.col("step").cast("string")
    return m.select(
        "run",
        "ord",
        F.when(
            F.col("tag") == "train/loss",
            F.concat(
                F.lit("{'loss': "), value, F.lit(", 'learning_rate': 1.5e-04, 'step': "),
                step, F.lit("}"),
            ),
        )
        .when(
            F.col("tag") == "eval/loss",
            F.concat(F.lit("{'eval_loss': "), value, F.lit(", 'step': "), step, F.lit("}")),
        )
        .otherwise(F.concat(F.lit("Waiting for training to complete "), step))
        .alias("line"),
    )


def trainer_states(spark: SparkSession, sf_dir: str, rows_per_state: int = 100) -> DataFrame:
    """``run, segment, document``: trainer-state JSON, one for at most ``rows_per_state`` events."""
    m = metrics(spark, sf_dir).filter(F.col("tag").isin("train/loss", "eval/loss"))
    row = F.struct(
        "ord",
        F.struct(
            F.when(F.col("tag") == "train/loss", F.col("value")).alias("loss"),
            F.when(F.col("tag") == "eval/loss", F.col("value")).alias("eval_loss"),
            "step",
        ).alias("row"),
    )
    return (
        m.withColumn("segment", F.expr(f"ord div {rows_per_state}"))
        .groupBy("run", "segment")
        .agg(
            F.sort_array(F.collect_list(row)).alias("rows"),
            F.max("step").alias("global_step"),
            F.min(F.when(F.col("tag") == "eval/loss", F.col("value"))).alias("best_metric"),
        )
        .select(
            "run",
            "segment",
            F.to_json(
                F.struct("best_metric", "global_step", F.col("rows.row").alias("log_history"))
            ).alias("document"),
        )
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, length``: files of runs named by event time; some names are no time, some files lack.

    Every event makes one file: of the model, of the logs or of a checkpoint.
    """
    eid = F.col("event_id")
    hour = F.date_trunc("HOUR", "ts")
    good = F.date_format(hour, "yyyyMMdd_HHmmss")
    name = (
        F.when(eid % 50 == 7, F.concat(F.date_format(hour, "yyyy"), F.lit("1301_000000")))
        .when(eid % 50 == 8, F.date_format(hour, "yyyyMMdd-HHmmss"))
        .when(eid % 50 == 9, F.date_format(hour, "yyyyMMdd_HHmm"))
        .otherwise(good)
    )
    inside = (
        F.when(F.col("event_type") == "error", F.lit("final_model/adapter_config.json"))
        .when(F.col("event_type") == "click", F.lit("final_model/adapter_model.safetensors"))
        .when(
            F.col("event_type") == "view",
            F.concat(F.lit("logs/events.out."), eid.cast("string")),
        )
        .when(
            F.col("event_type") == "signup",
            F.concat(
                F.lit("checkpoint-"), (200 * (eid % 13 + 1)).cast("string"),
                F.lit("/trainer_state.json"),
            ),
        )
        .otherwise(
            F.concat(F.lit("backup_1/checkpoint-"), (eid % 9).cast("string"), F.lit("/x.pt"))
        )
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit(BASE + "/"), name, F.lit("/"), inside).alias("path"),
        (eid * 1000 + 17).alias("length"),
    )


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run, step, path``: a checkpoint at every training step that 200 divides."""
    m = metrics(spark, sf_dir)
    return (
        m.filter((F.col("tag") == "train/loss") & (F.col("step") % 200 == 0))
        .select("run", "step")
        .distinct()
        .withColumn("path", F.concat(F.lit("checkpoint-"), F.col("step").cast("string")))
    )


def append_batch(place: str, numbers: list[int], lines: list[str]) -> None:
    """Append each line to the file of its number, in order; a file is opened once."""
    of_file: dict[int, list[str]] = {}
    for number, line in zip(numbers, lines):
        of_file.setdefault(number, []).append(line + "\n")
    for number, own in of_file.items():
        with open(f"{place}/app-{number}.log", "a") as file:
            file.write("".join(own))


def append_lines(lines: DataFrame, folder: str, files: int) -> None:
    """Append the only column of ``lines`` to the files ``app-<n>.log`` of a folder, as a program logs."""
    place = urlparse(folder).path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(place, exist_ok=True)
        for batch in batches:
            append_batch(place, *(c.to_pylist() for c in batch.columns))
            yield batch.slice(0, 0)

    numbered = lines.select(F.pmod(F.hash(lines.columns[0]), F.lit(files)).alias("n"), *lines.columns)
    numbered.repartition(files, "n").mapInArrow(run, numbered.schema).count()


def state_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """``trainer_states`` as files ``<run>/checkpoint-<step>/trainer_state.json`` of a folder."""
    place = urlparse(folder).path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run_, segment, document in zip(*(c.to_pylist() for c in batch.columns)):
                own = f"{place}/{run_}/checkpoint-{150 * (segment + 1)}"
                os.makedirs(own, exist_ok=True)
                with open(f"{own}/trainer_state.json", "w") as file:
                    file.write(document)
            yield batch.slice(0, 0)

    states = trainer_states(spark, sf_dir).select("run", F.col("segment").cast("long").alias("segment"), "document")
    states.mapInArrow(run, states.schema).count()
