"""Registered queries over the given tables, each with its DuckDB counterpart."""

from __future__ import annotations

from checks import cleaning, pipelines, reading, writing

MODULES = (reading, cleaning, writing, pipelines)


def all_queries() -> dict:
    return {name: fn for module in MODULES for name, (fn, _) in module.CHECKS.items()}


def all_sql() -> dict[str, str]:
    return {
        name: sql for module in MODULES for name, (_, sql) in module.CHECKS.items() if sql is not None
    }
