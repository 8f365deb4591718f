"""Language identification by Bayesian fusion of what a text, its markup and its address say.

For each language l the posterior is

    P(l | all)  ~  P(l | host) * P(text | l) * P(declared | l)

- ``P(text | l)``: byte trigrams of the lower-cased letters. The languages are those of all labelled
  rows, counted. The trigram probabilities are fitted on a random sample of each language's rows, drawn
  with a fixed seed: about ``TRAIN_ROWS`` in all, dealt so that only the most frequent languages give
  less than all their rows, and none less than ``LEAST_ROWS``; overlapping
  trigrams are no independent evidence, so the log-likelihood counts by a third. In a
  further class, ``und``, all trigrams are equally likely: what fits it better is in none of the
  languages. A text in two of them fits either one better than that.
- ``P(declared | l)``: how often texts of l are declared as each language, from all rows.
- ``P(l | host)``: the languages of all other rows of the host, smoothed towards those of its domain,
  these towards those of the address suffix, these towards those of all rows. Each level is an
  aggregate of the level below, so the large table is aggregated once, with partial sums.

The counts behind the last two weigh every row by what its text alone says; a row's own text does not
count in its own prior. A row is kept if the text has letters and ``und`` is not the likeliest.

Defined results: null and empty texts and texts without letters are ``und`` and are not kept; a null or
unknown declaration says nothing of its own, a null host has the prior of its suffix; repeated rows and
ties get equal results (ties go to the first language by name); an empty table gives an empty table;
columns with the names of new ones are left out. Without any labelled row all is ``und``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.llm.common import give_back, in_one, out_of_one, small_batches
from tunelake.session import ship_package, written

#: Labelled rows that the trigram probabilities are fitted on, and those that each language has at least.
TRAIN_ROWS, LEAST_ROWS = 20_000, 1_000
#: Trigrams share so many classes, by a hash.
CLASSES = 1 << 16
#: What a trigram counts, and rows that a level's parent counts for.
TEMPER, SMOOTHING = 1 / 3, 5.0
UNDETERMINED = "und"

_TRIGRAM_LENGTH = 3
_TO_SPACE = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Classes of the byte trigrams of the lower-cased text with at most one space."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace").translate(_TO_SPACE), np.uint8)
    if len(raw) < _TRIGRAM_LENGTH:
        return np.zeros(0, np.int64)
    a, b, c = raw[:-2].astype(np.uint32), raw[1:-1].astype(np.uint32), raw[2:].astype(np.uint32)
    few_spaces = (a == 32).astype(np.int8) + (b == 32) + (c == 32) < 2
    mixed = (a << 16 | b << 8 | c) * np.uint32(0x9E3779B1)
    return (mixed[few_spaces] >> 16).astype(np.int64)


def _map(df: DataFrame, function, schema) -> DataFrame:
    ship_package(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(small_batches(batches))
        give_back()

    return df.mapInArrow(each, schema)


def primary_language(tag: Column) -> Column:
    """``en`` for ``EN-us``; null stays null."""
    return F.lower(F.substring_index(F.substring_index(F.trim(tag), "-", 1), "_", 1))


def sampled_shares(counts: dict[str, int], rows: int) -> dict[str, float]:
    """The share of each language's rows to draw, ``rows`` in all.

    Languages are cut to one common number of rows, ``LEAST_ROWS`` or more; one with fewer gives all.
    """
    left, most = rows, 0
    for place, count in enumerate(ordered := sorted(counts.values())):
        most = left // (len(ordered) - place)
        if count > most:
            break
        left -= count
        most = count
    most = max(most, LEAST_ROWS)
    return {language: min(1.0, most / count) for language, count in counts.items()}


def fit(df: DataFrame, text: str, label: str, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probabilities of the trigram classes; the last row is that of ``und``."""
    labelled = df.select(F.col(text).alias("t"), primary_language(F.col(label)).alias("l")).filter(
        "l is not null and l <> ''"
    )
    labelled = labelled.filter("t is not null")
    of_language = {row["l"]: row["n"] for row in labelled.groupBy("l").agg(F.count("*").alias("n")).collect()}
    shares = sampled_shares(of_language, rows)
    sample = labelled if min(shares.values(), default=1) == 1 else labelled.sampleBy("l", shares, seed=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, tag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(tag, np.zeros(CLASSES, np.int64))
                counts[tag] += np.bincount(trigrams(value), minlength=CLASSES)
        for tag, of_tag in counts.items():
            seen = np.flatnonzero(of_tag)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tag] * len(seen), pa.string()), pa.array(seen), pa.array(of_tag[seen])],
                names=["l", "class", "n"],
            )

    counted = (
        _map(sample, run, "l string, class long, n long")
        .groupBy("l", "class")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # at most CLASSES rows for each language
    )
    languages = sorted(set(counted.column("l").to_pylist()))
    table = np.full((len(languages) + 1, CLASSES), 0.5)
    where = np.array([languages.index(tag) for tag in counted.column("l").to_pylist()], np.int64)
    np.add.at(table, (where, counted.column("class").to_numpy()), counted.column("n").to_numpy())
    return languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def strip_markup(page: str) -> tuple[str, str | None]:
    """The visible text of a page, and the language its markup declares."""
    tag = re.search(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]+)""", page, re.I)
    bare = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?(?:</\1\s*>|$)|<[^>]*>", " ", page)
    return html.unescape(bare), tag[1].lower() if tag else None


def with_page_evidence(df: DataFrame, page: str = "html", url: str = "url") -> DataFrame:
    """``df`` without the page, but with ``text``, ``declared`` and ``host``."""
    kept = [c for c in df.columns if c != page and c.lower() not in ("text", "declared", "host")]
    schema = T.StructType([df.schema[c] for c in kept])
    schema = schema.add("text", T.StringType()).add("declared", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [strip_markup(value or "") for value in batch.column(page).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.string())],
                names=[*kept, "text", "declared"],
            )

    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return _map(df, run, schema).withColumn("host", F.when(host != "", host))


def _scored(df: DataFrame, text: str, languages: list[str], table: np.ndarray) -> DataFrame:
    """``df`` with ``_like`` (log-likelihoods, ``und`` last), ``_share`` and ``_grams``."""
    given = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))
    kept = list(df.columns)
    schema = T.StructType(list(df.schema.fields))
    for name in ("_like", "_share"):
        schema = schema.add(name, T.ArrayType(T.DoubleType()))
    schema = schema.add("_grams", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(text).to_pylist()
            like = np.zeros((len(values), len(languages) + 1))
            grams = np.zeros(len(values), np.int64)
            for i, value in enumerate(values):
                classes = trigrams(value or "")
                grams[i] = len(classes)
                for part in range(0, len(classes), 1 << 16):  # bounded memory on very long texts
                    like[i] += given.value[classes[part : part + (1 << 16)]].sum(axis=0)
            like *= TEMPER
            share = np.exp(like - like.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            share[grams == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(list(like), pa.list_(pa.float64())),
                 pa.array(list(share), pa.list_(pa.float64())), pa.array(grams)],
                names=[*kept, "_like", "_share", "_grams"],
            )

    return _map(df, run, schema)


def _sums(size: int) -> list[Column]:
    return [F.sum(F.col("_share")[i]).alias(f"s{i}") for i in range(size)]


def _array(size: int, name: str = "s") -> Column:
    return F.array(*(F.coalesce(F.col(f"{name}{i}"), F.lit(0.0)) for i in range(size)))


def _smoothed(counts: Column, parent: Column) -> Column:
    """Shares of the counts, with the parent's shares counted as some more rows."""
    total = F.aggregate(counts, F.lit(0.0), lambda sum_, n: sum_ + n)
    return F.zip_with(counts, parent, lambda n, p: (n + SMOOTHING * p) / (total + SMOOTHING))


def host_levels(scored: DataFrame, size: int) -> DataFrame:
    """A row for each host: the sums of its rows, and the smoothed shares of what is above it."""
    hosts = scored.groupBy(F.coalesce("_host", F.lit("")).alias("_of")).agg(*_sums(size))
    labels = F.split("_of", "\\.")
    hosts = hosts.select(
        "_of",
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("_domain"),
        F.element_at(labels, -1).alias("_suffix"),
        *(f"s{i}" for i in range(size)),
    )
    total = [F.sum(f"s{i}").alias(f"s{i}") for i in range(size)]
    domains = hosts.groupBy("_domain", "_suffix").agg(*total)
    suffixes = domains.groupBy("_suffix").agg(*total)
    everything = suffixes.agg(*total).select(
        _smoothed(_array(size), F.array(*[F.lit(1.0 / size)] * size)).alias("_all")
    )
    top = everything.first()["_all"]  # one row
    suffixes = suffixes.select(
        F.col("_suffix").alias("_up"),
        _smoothed(_array(size), F.array(*map(F.lit, top))).alias("_suffix_share"),
    )
    domains = domains.join(suffixes, F.col("_suffix") == F.col("_up")).select(
        F.col("_domain").alias("_up_domain"),
        F.col("_suffix").alias("_up_suffix"),
        _smoothed(_array(size), F.col("_suffix_share")).alias("_parent"),
    )
    same = (F.col("_domain") == F.col("_up_domain")) & (F.col("_suffix") == F.col("_up_suffix"))
    return hosts.join(domains, same).select("_of", _array(size).alias("_host_sums"), "_parent")


def declaration_odds(scored: DataFrame, size: int) -> dict[str, list[float]]:
    """For each declared language the log-probability of the declaration in texts of each language."""
    rows = (
        scored.filter("_declared is not null")
        .groupBy("_declared")
        .agg(*_sums(size))
        .collect()  # declarations outside the known languages are one class
    )
    counts = {row["_declared"]: np.array([row[f"s{i}"] or 0.0 for i in range(size)]) for row in rows}
    if not counts:
        return {}
    total = sum(counts.values())
    return {
        tag: np.log((n + 0.5) / (total + 0.5 * len(counts))).tolist() for tag, n in counts.items()
    }


def identify(
    df: DataFrame,
    model: tuple[list[str], np.ndarray],
    text: str = "text",
    declared: str | None = "declared",
    host: str | None = "host",
) -> DataFrame:
    """``df`` with ``language``, its ``probability`` and ``kept``.

    The texts are scored four times: for the hosts' sums, once more for the sum of all of them, for the
    declarations, and for the result.
    """
    languages, table = model
    size = len(languages) + 1
    new = ("language", "probability", "kept")
    kept = [c for c in df.columns if c.lower() not in new]
    none = F.lit(None).cast("string")
    tag = primary_language(F.col(declared)) if declared else none
    other = F.when(tag.isin(languages or [""]), tag).when(tag.isNotNull(), F.lit("?"))
    others = [c for c in kept if c != text]
    rows = df.select(
        in_one(others), F.col(text).alias("text"), other.alias("_declared"),
        (F.col(host) if host else none).alias("_host"),
    )
    slim = _scored(rows.select("text", "_declared", "_host"), "text", languages, table)
    # Written first: a join of two tables can be split where one host holds very many rows.
    levels = written(host_levels(slim, size), "hosts")
    odds = declaration_odds(slim, size)
    said = F.lit(None).cast("array<double>")
    for tag_value, values in odds.items():
        said = F.when(F.col("_declared") == tag_value, F.array(*map(F.lit, values))).otherwise(said)
    nothing = F.array(*[F.lit(0.0)] * size)
    scored = _scored(rows, "text", languages, table)
    rest = F.zip_with("_host_sums", "_share", lambda n, own: F.greatest(n - own, F.lit(0.0)))
    prior = _smoothed(rest, F.col("_parent"))
    fused = F.zip_with(
        F.zip_with("_like", prior, lambda like, p: like + F.log(p)),
        F.coalesce(said, nothing),
        lambda x, d: x + d,
    )
    most = F.array_max("_fused")
    scale = F.aggregate("_fused", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - F.col("_most")))
    names = F.array(*map(F.lit, [*languages, UNDETERMINED]))
    best = F.element_at(names, F.array_position("_fused", F.col("_most")).cast("int"))
    has_text = F.col("_grams") > 0
    return (
        scored.join(levels, F.coalesce("_host", F.lit("")) == F.col("_of"))
        .withColumn("_fused", fused)
        .withColumn("_most", most)
        .select(
            "own",
            "text",
            F.when(has_text, best).otherwise(UNDETERMINED).alias("language"),
            F.when(has_text, 1 / scale).otherwise(F.lit(0.0)).alias("probability"),
            (has_text & (best != UNDETERMINED)).alias("kept"),
        )
        .select(*out_of_one(kept, text=text), *new)
    )
