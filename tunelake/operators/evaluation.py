"""Scoring of predictions against expected records, by record and by field."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.constants import RECORD_FIELDS
from tunelake.functions.strict_json import parse_or_error, record_type, with_strict_object
from tunelake.session import ship_package

STATUSES = ["ok", "empty", "no_json", "malformed"]


# A string, or a number that ends in zeros behind its point.
_STRING_OR_WHOLE = r'("(?:[^"\\]|\\.)*+")|(-?[0-9]+)\.0++(?![0-9Ee])'


def _by_value(text: Column) -> Column:
    """JSON with numbers written by value; most texts hold no such number and are not searched."""
    return F.get(
        F.transform(
            F.array(text),
            lambda t: F.when(F.contains(t, F.lit(".0")), F.regexp_replace(t, _STRING_OR_WHOLE, "$1$2")).otherwise(t),
        ),
        F.lit(0),
    )


def object_members(text: Column) -> Column:
    """The members of a JSON object by key: ``key`` and ``value`` as JSON in one fixed form.

    Values keep their type; numbers are written by value (``1.0`` as ``1``), inner objects in key
    order. Of a key that stands twice the last one counts, as Python has it. Null where the text is
    no object, or an inner object holds a key twice.
    """
    placed = F.transform(
        F.map_entries(F.from_json(text, "map<string, variant>")),
        lambda m, i: F.struct(
            m["key"].alias("key"),
            i.alias("place"),
            _by_value(F.to_json(m["value"])).alias("value"),
        ),
    )

    def last_ones(sorted_: Column) -> Column:
        """Of sorted members those that the next one does not repeat."""
        return F.filter(sorted_, lambda m, i: ~m["key"].eqNullSafe(F.get(sorted_, i + 1)["key"]))

    last = F.get(F.transform(F.array(F.sort_array(placed)), last_ones), F.lit(0))
    return F.transform(last, lambda m: F.struct(m["key"].alias("key"), m["value"].alias("value")))


def _tree(value: object) -> str:
    """One text for all values that are equal once parsed; NaN is read as one and the same object."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_tree(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_tree, value)) + "]"
    if isinstance(value, (bool, int)):
        return str(int(value))
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() else repr(value)
    return json.dumps(value)


def canonical_object(text: str | None) -> str | None:
    """A JSON object in one fixed form at every depth; None for what is none.

    As Python compares what it parses: the last one of equal keys counts, numbers go by value, ``true``
    is ``1``.
    """
    try:
        value = json.loads(text)
        return _tree(value) if isinstance(value, dict) else None
    except (TypeError, ValueError, OverflowError, RecursionError):
        return None


def _canonical(text: Column) -> Column:
    if session := SparkSession.getActiveSession():
        ship_package(session)

    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(canonical_object)

    return form(text)


def _deep(text: Column) -> Column:
    """Whether a JSON text may hold inner objects or truth values."""
    inner = F.locate("{", text, 2) > 0
    return F.coalesce(inner | F.contains(text, F.lit("true")) | F.contains(text, F.lit("false")), F.lit(False))


def _member(members: Column, key: str) -> Column:
    """The value of a member; null where it is ``null`` or not there."""
    value = F.get(F.filter(members, lambda m: m["key"] == key), F.lit(0))["value"]
    return F.nullif(value, F.lit("null"))


def score_predictions(
    expected: DataFrame,
    predicted: DataFrame,
    key: list[str],
    fields: list[str] = RECORD_FIELDS,
) -> DataFrame:
    """Compare ``expected_json`` with ``predicted_json`` for each key.

    ``match`` is true where both are objects with the same keys and equal values, in any key order.
    Values are compared with their types: ``"4"`` is not ``4``, ``1.0`` is ``1``. Each prediction of
    a key is a sample of its own; a caller who wants one for each key drops the others first.
    A missing or unparsable prediction does not match. ``<field>_match`` compares single fields; a
    field that both leave null or out is equal, and no prediction is no match.

    Parsing costs far more than reading, so the pairs are dealt by key before it: a side that looks small,
    as texts are packed well, would otherwise be broadcast, and all be parsed by the few tasks that scan.
    Result: key, ``match``, the field columns, ``error``, ``raw``.
    """
    joined = expected.select(*key, "expected_json").join(
        predicted.select(*key, "predicted_json").hint("merge"), key, "left"
    )
    parsed = with_strict_object(joined, "expected_json", record_type(fields), "expected")
    parsed = parse_or_error(parsed, "predicted_json", fields, "predicted")
    expected_record, predicted_record = F.col("expected"), F.col("predicted")
    usable = expected_record.isNotNull() & predicted_record.isNotNull()
    own, other = F.col("_expected_members"), F.col("_predicted_members")
    expected_text, predicted_text = F.col("expected_json"), F.col("predicted_json")
    deep = _deep(expected_text) | _deep(predicted_text)
    exact = _canonical(F.when(deep, expected_text)) == _canonical(F.when(deep, predicted_text))
    same = F.coalesce(F.when(deep, exact).otherwise(own == other), F.lit(False))
    field_match = {
        f"{f}_match": usable & _member(own, f).eqNullSafe(_member(other, f)) for f in fields
    }
    return (
        parsed.withColumn("_expected_members", object_members(F.col("expected_json")))
        .withColumn("_predicted_members", object_members(F.col("predicted_json")))
        .withColumns(field_match)
        .withColumn("match", usable & same)
        .select(*key, "match", *field_match, "error", "raw")
    )


def same_object(left: Column, right: Column) -> Column:
    """Whether two JSON objects of any keys are equal, as Python compares them.

    Flat objects are compared by built-in functions. Only pairs in which one may hold inner objects or
    truth values go to Python, in Arrow batches; others are nulls there.
    """
    deep = _deep(left) | _deep(right)
    exact = _canonical(F.when(deep, left)) == _canonical(F.when(deep, right))
    return F.coalesce(F.when(deep, exact).otherwise(object_members(left) == object_members(right)), F.lit(False))


def dealt_out(pairs: DataFrame) -> DataFrame:
    """The same rows, dealt evenly to as many tasks as their size asks for, ahead of ``same_object``.

    Parsing costs far more than reading: rows would else be parsed by the few tasks that scan, or that hold
    a frequent key. They are dealt by all columns, so that the rows of one key go apart.
    """
    return pairs.hint("rebalance", *pairs.columns)


def exact_match_accuracy(scored: DataFrame) -> DataFrame:
    """Samples, exact matches and their share in percent; null share where there are no samples."""
    return scored.agg(
        F.count(F.lit(1)).alias("samples"), F.count_if("match").alias("correct")
    ).withColumn("accuracy_pct", F.try_divide(F.col("correct") * 100.0, F.col("samples")))


def _field_table(pairs: list[tuple[str, Column]], key: str, value: str) -> Column:
    return F.inline(
        F.array(*[F.struct(F.lit(name).alias(key), col.alias(value)) for name, col in pairs])
    )


def field_accuracy(scored: DataFrame, fields: list[str] = RECORD_FIELDS) -> DataFrame:
    """Share of samples whose field is right, in percent, for every field.

    One pass computes all shares; only the single result row is turned into a table.
    """
    hits = [F.count_if(f"{f}_match").alias(f"_{f}") for f in fields]
    totals = scored.agg(F.count(F.lit(1)).alias("_n"), *hits)
    shares = [(f, F.try_divide(F.col(f"_{f}") * 100.0, F.col("_n"))) for f in fields]
    return totals.select(_field_table(shares, "field", "accuracy_pct"))


def parse_rate(outputs: DataFrame, status: str = "status") -> DataFrame:
    """Number and share of outputs for every recovery status."""
    counts = [F.count_if(F.col(status) == s).alias(f"_{s}") for s in STATUSES]
    totals = outputs.agg(F.count(F.lit(1)).alias("_n"), *counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("status"),
                F.col(f"_{s}").alias("outputs"),
                F.try_divide(F.col(f"_{s}") * 100.0, F.col("_n")).alias("share_pct"),
            )
            for s in STATUSES
        ]
    )
    return totals.select(F.inline(rows))


def compare_runs(
    outputs: DataFrame,
    run_a: str,
    run_b: str,
    key: list[str],
    fields: list[str] = RECORD_FIELDS,
) -> DataFrame:
    """Fields in which two runs differ on a sample: key, ``field, value_a, value_b``.

    ``outputs`` has one row for each run and sample, with the fields as columns. Both runs meet in
    one aggregation by sample, so the table is read and shuffled once. A sample that only one run
    has differs in the fields that run fills.
    """
    sides = [("a", run_a), ("b", run_b)]
    picked = [
        F.max(F.when(F.col("run") == run, F.col(f))).alias(f"{f}_{side}")
        for f in fields
        for side, run in sides
    ]
    paired = outputs.filter(F.col("run").isin(run_a, run_b)).groupBy(*key).agg(*picked)
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{f}_a").alias("value_a"),
                F.col(f"{f}_b").alias("value_b"),
            )
            for f in fields
        ]
    )
    differing = F.filter(cells, lambda c: ~c["value_a"].eqNullSafe(c["value_b"]))
    return paired.select(*key, F.inline(differing))
