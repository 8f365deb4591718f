"""JSON text: strict acceptance, recovery from free text, dumping, key checks.

``from_json`` stops after the first value and so accepts trailing text. Here the text is put inside
a list, followed by a second member that holds a hash of the text: the list must have exactly one
element and the hash must come back. Trailing text, two values, single quotes, bare keys, unclosed
brackets and trailing commas then all fail, and one parse gives both the verdict and the record.

Known differences from Python's parser: a number in a string field arrives as its text (``1.50`` as
``1.5``), and a number or object as instruction text is kept as JSON text.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.constants import PARSE_ERROR, RECORD_FIELDS
from tunelake.functions.text import strip

_OPTIONS = {"allowSingleQuotes": "false"}


def record_type(fields: list[str] = RECORD_FIELDS) -> str:
    """DDL of a record: every field a nullable string."""
    return "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"


def _seal(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def _sealed_parse(text: Column, element_type: str) -> Column:
    wrapped = F.concat(F.lit('{"v":['), text, F.lit('],"seal":"'), _seal(text), F.lit('"}'))
    return F.from_json(wrapped, f"v array<{element_type}>, seal string", _OPTIONS)


def is_json(text: Column) -> Column:
    """Whether the text is exactly one JSON value of any kind."""
    parsed = _sealed_parse(text, "string")
    return F.coalesce((F.size(parsed["v"]) == 1) & (parsed["seal"] == _seal(text)), F.lit(False))


def with_strict_object(df: DataFrame, column: str, element_type: str, into: str) -> DataFrame:
    """Add ``into``: the record if the text in ``column`` is exactly one JSON object, else null."""
    scratch = f"_{into}_parsed"
    parsed = F.col(scratch)
    accepted = (F.size(parsed["v"]) == 1) & (parsed["seal"] == _seal(F.col(column)))
    return (
        df.withColumn(scratch, _sealed_parse(F.col(column), element_type))
        .withColumn(into, F.when(accepted, F.get(parsed["v"], F.lit(0))))
        .drop(scratch)
    )


def _all_null(record: Column, fields: list[str]) -> Column:
    test = F.lit(True)
    for field in fields:
        test = test & record[field].isNull()
    return test


def extract_json(
    df: DataFrame,
    column: str,
    fields: list[str] = RECORD_FIELDS,
    record: str = "record",
    status: str = "status",
) -> DataFrame:
    """Recover a record from free text: the slice from the first ``{`` to the last ``}``.

    ``status`` is ``ok``, ``empty`` (the object has no keys), ``no_json`` (no opening brace) or
    ``malformed`` (a brace, but the slice is not one JSON object). Null text counts as ``no_json``.
    """
    block = "_json_block"
    text = F.col(column)
    start = F.instr(text, "{")
    end = F.length(text) - F.instr(F.reverse(text), "}") + 1  # past the end without any
    found = (start > 0) & (end <= F.length(text)) & (end > start)
    # Two searches for a character: a text of braces only costs no more than any other.
    out = df.withColumn(
        block, F.when(found, F.substr(text, start, end - start + 1)).otherwise(F.lit(""))
    )
    out = with_strict_object(out, block, record_type(fields), record)
    verdict = (
        F.when(~F.coalesce(F.contains(F.col(column), F.lit("{")), F.lit(False)), "no_json")
        .when(F.col(record).isNull(), "malformed")
        .when(
            _all_null(F.col(record), fields) & (F.size(F.json_object_keys(block)) == 0), "empty"
        )
        .otherwise("ok")
    )
    return out.withColumn(status, verdict).drop(block)


def parse_or_error(
    df: DataFrame,
    column: str,
    fields: list[str] = RECORD_FIELDS,
    record: str = "predicted",
) -> DataFrame:
    """Parse the whole text. What is not JSON gets ``error`` and ``raw`` instead of a record.

    JSON that is not an object is no error, but gives no record either, so it never matches one.
    """
    out = with_strict_object(df, column, record_type(fields), record)
    failed = F.col(record).isNull() & ~is_json(F.col(column))
    return out.withColumn("error", F.when(failed, F.lit(PARSE_ERROR))).withColumn(
        "raw", F.when(F.col("error").isNotNull(), F.col(column))
    )


def check_record_schema(
    df: DataFrame, column: str, fields: list[str] = RECORD_FIELDS
) -> DataFrame:
    """Compare the keys of a JSON object with the declared ones: ``missing, extra, schema_ok``.

    Text that is not an object misses every field.
    """
    declared = F.array(*[F.lit(f) for f in fields])
    out = with_strict_object(df, column, record_type(fields), "_checked").withColumn(
        "_keys",
        F.when(F.col("_checked").isNotNull(), F.json_object_keys(column)).otherwise(
            F.array().cast("array<string>")
        ),
    )
    missing = F.array_except(declared, F.col("_keys"))
    extra = F.array_except(F.col("_keys"), declared)
    return (
        out.withColumn("missing", missing)
        .withColumn("extra", extra)
        .withColumn("schema_ok", (F.size("missing") == 0) & (F.size("extra") == 0))
        .drop("_checked", "_keys")
    )


def select_fields(df: DataFrame, record: str, fields: list[str] = RECORD_FIELDS) -> DataFrame:
    """The declared fields of a record as columns, in declared order."""
    others = [c for c in df.columns if c != record]
    return df.select(*others, *[F.col(record)[f].alias(f) for f in fields])


def _lower_control_escapes(text: Column) -> Column:
    """``\\u001f`` where Jackson writes ``\\u001F``; after an escaped backslash it is plain text."""
    codes = [f"{c:04X}" for c in range(0x20) if not f"{c:04x}".isdigit()]

    def lower_one(done: Column, code: Column) -> Column:
        pattern = F.concat(F.lit(r"(?<!\\)((?:\\\\)*)\\u"), code)
        return F.regexp_replace(done, pattern, F.concat(F.lit(r"$1\\u"), F.lower(code)))

    return F.when(
        F.contains(text, F.lit(r"\u00")),
        F.aggregate(F.array(*[F.lit(c) for c in codes]), text, lower_one),
    ).otherwise(text)


def _dumped_with_controls(record: Column, fields: list[str]) -> Column:
    """Any record, by Spark's own writer, with Python's spacing and lower-case escapes.

    A quote inside a value always has a backslash before it, so a field name in quotes right after a
    brace or comma can only be a key.
    """
    text = F.to_json(
        F.struct(*[record[f].alias(f) for f in fields]), {"ignoreNullFields": "false"}
    )
    names = "|".join(re.escape(json.dumps(f, ensure_ascii=False)) for f in fields)
    text = F.regexp_replace(text, f"(?<=[{{,])({names}):", "$1: ")
    text = F.regexp_replace(text, f",({names}): ", ", $1: ")
    return F.get(F.transform(F.array(text), _lower_control_escapes), F.lit(0))


def _quoted(value: Column) -> Column:
    escaped = F.replace(
        F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )
    return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("null"))


def dumps_record(record: Column, fields: list[str] = RECORD_FIELDS) -> Column:
    """A record as ``json.dumps(record, ensure_ascii=False)`` writes it.

    Separators are ``", "`` and ``": "``, nulls are written, fields keep their order, non-ASCII
    characters stay as they are. Records without control characters, nearly all, take a short way.
    """
    members = [
        F.concat(F.lit(json.dumps(f, ensure_ascii=False) + ": "), _quoted(record[f])) for f in fields
    ]
    plain = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    return (
        F.when(record.isNull(), F.lit("null"))
        .when(F.rlike(plain, F.lit(r"[\x00-\x1f]")), _dumped_with_controls(record, fields))
        .otherwise(plain)
    )


def stripped_blank(text: Column) -> Column:
    """Whether nothing but white space is there."""
    return F.coalesce(strip(text) == "", F.lit(True))
