"""Every operator as a query over the given tables, next to the SQL that must give the same rows."""

from __future__ import annotations

import importlib

_THEMES = ["metrics", "examples", "evaluation", "catalog", "logs", "streams"]


def all_queries():
    """``(queries, oracles)`` by name."""
    for theme in _THEMES:
        importlib.import_module(f"tunelake.checks.{theme}")
    from tunelake.checks.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
