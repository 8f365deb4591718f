"""A corpus made ready for training: each stage works on the documents that the one before kept.

Stages take (spark, docs, sf_dir) and return the documents, with all their columns, that go on; the
last one returns where the pieces of each document go in the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import language, near_duplicates, packing, privacy, quality
from tunelake.llm.common import in_one, out_of_one
from tunelake.session import written

#: Words that a worker keeps for packing, and characters that it works on at a time; less than for packing
#: alone, as the executor has grown over the stages before and other workers wait beside it.
CACHED_WORDS, CHARACTERS = 100_000, 250_000

#: Rows that Spark hands to a Python worker at a time: texts pass in and out, and a batch of the default
#: size holds tens of megabytes several times over.
ARROW_ROWS = "1000"

#: No stage of it can be written as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for what is planned from now on, where nobody has set their size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, ARROW_ROWS)


def _kept_rows(
    docs: DataFrame, needed: Iterable[str], judge: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows that ``judge`` marks as ``kept``; it sees the columns it needs, the others wait in one."""
    others = [c for c in docs.columns if c not in needed]
    judged = judge(docs.select(in_one(others).alias("document"), *needed)).filter("kept")
    return judged.withColumnRenamed("document", "own").select(*out_of_one(docs.columns, **{c: c for c in needed}))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents in none of the languages, or without letters, go."""
    _small_batches(spark)
    model = language.fit(docs, "text", "lang")
    return _kept_rows(
        docs,
        ("text", "lang", "source"),
        lambda df: language.identify(df, model, declared="lang", host="source"),
    )


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or are more likely bad than good go."""
    return _kept_rows(docs, ("text",), quality.score)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: one document of each group of copies and near-copies stays."""
    _small_batches(spark)
    return near_duplicates.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: entities and the terms that disclose them are replaced in the texts."""
    _small_batches(spark)
    hidden = privacy.sanitise(docs)
    if "n_chars" not in docs.columns:
        return hidden
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the place of each document's pieces in sequences of bounded length."""
    _small_batches(spark)
    return packing.pack(docs, cached_words=CACHED_WORDS, characters=CHARACTERS, release=True)


STAGES = [
    ("language", keep_known_languages),
    ("quality", keep_good_quality),
    ("near_duplicates", keep_one_of_each),
    ("personal_data", hide_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
