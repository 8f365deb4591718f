"""Token counts from an exact histogram of encoded lengths.

Documents are reduced to the number of tokens they encode to, and counted by that number: partial
counts in each task first. Everything else is asked of the histogram, whose size is the number of
different lengths. Running sums from the longest length down give, for every length taken as a context
limit: documents and tokens up to it and beyond it, the tokens left when longer documents are cut, and
the share of documents that fit, which answers quantiles. Limits between lengths are added as lengths
that no document has. The sums run within blocks of lengths; a table with one row for each block
carries what lies beyond.

Defined results: a null text counts as empty and has no tokens; repeated rows count each; an empty
table gives an empty histogram, and no rows but the asked limits; other columns are left out.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import map_batches

#: Lengths in a block, as a power of two.
BLOCK_BITS = 10


@lru_cache(maxsize=2)
def _encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lengths(
    df: DataFrame,
    text: str = "text",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The number of tokens of each document, as ``length``."""
    rank_file = rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = _encoding(rank_file, pattern).encode_ordinary
        counts = [len(encode(value)) if value else 0 for value in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["length"])

    return map_batches(df.select(text), run, "length long")


def length_histogram(df: DataFrame, **options) -> DataFrame:
    """Documents by encoded length: ``length``, ``documents``."""
    return lengths(df, **options).groupBy("length").agg(F.count(F.lit(1)).alias("documents"))


def limits(histogram: DataFrame, asked: list[int] | None = None) -> DataFrame:
    """What holds for every length, and every asked limit, as context limit.

    ``documents`` and ``tokens`` of that length; ``documents_within``, ``tokens_within`` up to it;
    ``documents_beyond``, ``tokens_beyond``; ``truncated_tokens`` with longer documents cut to it;
    ``share_within`` of the documents.
    """
    histogram = histogram.select("length", "documents")
    if asked:
        more = histogram.sparkSession.createDataFrame(
            [(int(limit), 0) for limit in set(asked)], "length long, documents long"
        )
        histogram = (
            histogram.unionByName(more).groupBy("length").agg(F.sum("documents").alias("documents"))
        )
    rows = histogram.withColumn("tokens", F.col("length") * F.col("documents")).withColumn(
        "_block", F.shiftright("length", BLOCK_BITS)
    )
    blocks = rows.groupBy("_block").agg(
        F.sum("documents").alias("_documents"), F.sum("tokens").alias("_tokens")
    )
    above = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    carried = blocks.select(
        F.col("_block").alias("_of"),
        *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_documents", "_tokens")),
        *(F.sum(c).over(everything).alias(f"{c}_all") for c in ("_documents", "_tokens")),
    )
    inside = (
        Window.partitionBy("_block")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beyond = {
        c: F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_{c}_near")
        for c in ("documents", "tokens")
    }
    return (
        rows.select("*", *beyond.values())
        .join(carried, F.col("_block") == F.col("_of"))
        .withColumn("documents_beyond", F.col("_documents_near") + F.col("_documents_above"))
        .withColumn("tokens_beyond", F.col("_tokens_near") + F.col("_tokens_above"))
        .withColumn("documents_within", F.col("_documents_all") - F.col("documents_beyond"))
        .withColumn("tokens_within", F.col("_tokens_all") - F.col("tokens_beyond"))
        .select(
            "length",
            "documents",
            "tokens",
            "documents_within",
            "tokens_within",
            "documents_beyond",
            "tokens_beyond",
            (F.col("tokens_within") + F.col("length") * F.col("documents_beyond")).alias(
                "truncated_tokens"
            ),
            F.try_divide(F.col("documents_within"), F.col("_documents_all")).alias("share_within"),
        )
    )


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """For each share the shortest length within which that share of documents lies."""
    return table.agg(
        *(
            F.min(F.when(F.col("share_within") >= share, F.col("length"))).alias(f"q{share:g}")
            for share in shares
        )
    )


def with_quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """``table`` of ``limits`` with ``quantiles``: the shares whose quantile is this length, else null.

    A row tells it alone: its share of documents is reached, and without its own documents it is not.
    """
    total = F.col("documents_within") + F.col("documents_beyond")
    shorter = F.try_divide(F.col("documents_within") - F.col("documents"), total)
    reached = F.filter(
        F.array(*(F.lit(float(s)) for s in shares)),
        lambda s: (F.col("share_within") >= s) & (shorter < s),
    )
    named = F.array_join(F.transform(reached, lambda s: s.cast("string")), ",")
    return table.withColumn("quantiles", F.when(F.size(reached) > 0, named))
