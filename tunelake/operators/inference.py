"""Batch inference: prompts in, full model outputs out, as a distributed job around a user's model."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.constants import GENERATION_PARAMS
from tunelake.session import new_folder

# prompts and parameters in, one full output (prompt included) for each prompt out
Model = Callable[[list[str], dict], list[str]]

_loaded: dict[str, Model] = {}


def _model_of_process(key: str, make: Callable[[], Model]) -> Model:
    """The model of one call (and run); a worker holds the latest one only."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = make()
    return _loaded[key]


def batch_infer(
    prompts: DataFrame,
    model_factory: Callable[..., Model],
    id_column: str = "id",
    params: dict | None = None,
    batch_size: int = 32,
    partitions: int | None = None,
    run_column: str | None = None,
) -> DataFrame:
    """Run a model over ``prompt``: the columns of ``prompts`` and ``full_output``.

    The model is made by ``model_factory`` once in each Python worker process for each call of this
    function; it gets at most ``batch_size`` prompts at a time. ``partitions`` spreads the prompts
    evenly over that many tasks, which matters because a prompt costs far more than a row.

    With ``run_column``, ``model_factory`` gets a row's run and makes that run's model. Rows are then
    ordered by run within tasks, so a task loads a model once for each of its runs, and range
    partitions split a large run over several tasks.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    settings = dict(GENERATION_PARAMS, **(params or {}))
    call = uuid.uuid4().hex
    rows = prompts
    if run_column:
        spread = [partitions] if partitions else []
        rows = rows.repartitionByRange(*spread, run_column, id_column).sortWithinPartitions(run_column)
    elif partitions:
        rows = rows.repartition(partitions)

    def answer(part: pd.DataFrame, model: Model) -> Iterator[pd.DataFrame]:
        for start in range(0, len(part), batch_size):
            few = part.iloc[start : start + batch_size]
            outputs = model(few["prompt"].tolist(), settings)
            if len(outputs) != len(few):
                raise ValueError("the model must give one output for each prompt")
            yield few.assign(full_output=outputs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not run_column:
                yield from answer(batch, _model_of_process(call, model_factory))
                continue
            for name, part in batch.groupby(run_column, sort=False, dropna=False):
                model = _model_of_process(f"{call}:{name}", lambda name=name: model_factory(name))
                yield from answer(part, model)

    schema = T.StructType([*rows.schema.fields, T.StructField("full_output", T.StringType())])
    return rows.mapInPandas(run, schema)


def stored_answers(spark: SparkSession, folder: str) -> DataFrame:
    """``prompt_digest, full_output`` of all blocks that ``infer_missing`` has finished in ``folder``."""
    schema = "prompt_digest string, full_output string"
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    blocks = [f"{folder}/{name}" for name in _names(spark, folder) if name.startswith("block-")]
    whole = [b for b in blocks if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{b}/_SUCCESS"))]
    return spark.read.schema(schema).parquet(*whole) if whole else spark.createDataFrame([], schema)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none where there is no folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def infer_missing(
    prompts: DataFrame,
    model_factory: Callable[..., Model],
    folder: str,
    params: dict | None = None,
    blocks: int = 16,
    run_column: str | None = None,
    **how,
) -> DataFrame:
    """``batch_infer`` that can be taken up again: only prompts without a stored answer meet the model.

    An answer is stored under a digest of prompt, run and parameters, so equal prompts are answered once
    and other parameters ask anew. What is missing is answered in ``blocks`` parts by the digest, each in a
    folder of its own, so that a part reads its own prompts only; a part is stored when all of it is answered. After a failure the parts before it stay, and a
    second call goes on with the part that failed. ``folder`` is for one model: a new one takes a new
    folder. Gives the columns of ``prompts`` and ``full_output``.
    """
    spark, folder = prompts.sparkSession, folder.rstrip("/")
    settings = json.dumps(dict(GENERATION_PARAMS, **(params or {})), sort_keys=True)
    asked = F.struct("prompt", *([F.col(run_column).cast("string").alias("run")] if run_column else []))
    digest = F.sha2(F.concat(F.to_json(asked), F.lit(settings)), 256)
    keyed = prompts.withColumn("prompt_digest", digest)
    block = F.pmod(F.xxhash64("prompt_digest"), F.lit(blocks)).alias("prompt_block")
    # The block leads all keys, so that rows come out of the aggregation in the order of the folders.
    key = ["prompt_block", "prompt_digest"]
    new = keyed.select(block, "prompt_digest", "prompt", *([run_column] if run_column else [])).dropDuplicates(key)
    missing = new.join(stored_answers(spark, folder).select(block, "prompt_digest"), key, "left_anti")
    place = new_folder(spark, "missing")
    missing.write.partitionBy("prompt_block").parquet(place)
    rows = missing.drop("prompt_block").schema
    open_blocks = (n.removeprefix("prompt_block=") for n in _names(spark, place) if n.startswith("prompt_block="))
    for number in sorted(map(int, open_blocks)):  # ``blocks`` at most
        part = spark.read.schema(rows).parquet(f"{place}/prompt_block={number}")
        answers = batch_infer(part, model_factory, "prompt_digest", params, run_column=run_column, **how)
        answers.select("prompt_digest", "full_output").write.parquet(f"{folder}/block-{uuid.uuid4().hex}")
    return keyed.join(stored_answers(spark, folder), "prompt_digest").select(*prompts.columns, "full_output")


def run_sample_grid(samples: DataFrame, runs: list[str]) -> DataFrame:
    """Every sample once for each of the named runs.

    The runs are the caller's short list, so the grid is an explode and moves no data.
    """
    return samples.withColumn("run", F.explode(F.array(*[F.lit(r) for r in runs])))
