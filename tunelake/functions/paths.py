"""Expressions over paths, run names and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RUN_NAME = r"^\d{8}_\d{6}$"


def run_started_at(name: Column) -> Column:
    """Time in a run name ``YYYYMMDD_HHMMSS``; null where the name is not such a time."""
    date = F.concat_ws("-", *[F.substring(name, at, n) for at, n in ((1, 4), (5, 2), (7, 2))])
    time = F.concat_ws(":", *[F.substring(name, at, 2) for at in (10, 12, 14)])
    spelled_out = F.concat(date, F.lit(" "), time)
    return F.when(F.rlike(name, F.lit(_RUN_NAME)), spelled_out.try_cast("timestamp"))


def checkpoint_step(path: Column) -> Column:
    """The whole number after the last ``-``; null where there is none."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "-", -1).try_cast("bigint")


def contains_any(text: Column, patterns: list[str]) -> Column:
    """Whether any pattern occurs in the text as it stands."""
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.contains(text, F.lit(pattern))
    return found


def artifact_key(prefix: str, relative: Column) -> Column:
    """Object key: prefix and relative path, with forward slashes."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.replace(relative, F.lit("\\"), F.lit("/")))


def relative_key(key: Column, prefix: str) -> Column:
    """Key without its leading prefix and the slashes after it; null for other keys."""
    return F.when(
        F.startswith(key, F.lit(prefix)),
        F.ltrim(F.substr(key, F.lit(len(prefix) + 1)), F.lit("/")),
    )


def artifact_kind(path: Column) -> Column:
    """``checkpoint``, ``backup`` or ``final_model`` by the folder names on the path, else ``other``.

    The outermost such folder decides, so a checkpoint inside a backup belongs to the backup.
    """
    folder = F.regexp_extract(path, r"(?:^|/)(checkpoint-|backup_|final_model(?=/|$))[^/]*", 1)
    return (
        F.when(folder == "checkpoint-", "checkpoint")
        .when(folder == "backup_", "backup")
        .when(folder == "final_model", "final_model")
        .otherwise("other")
    )


def megabytes(length: Column) -> Column:
    """Bytes as megabytes with two decimals."""
    return F.round(length / F.lit(1024 * 1024), 2)
