"""Registry of named queries over the driver tables.

Each entry is a Spark builder ``(spark, sf_dir) -> DataFrame`` plus, where
SQL can express it, the equivalent DuckDB SQL over the same tables.  Query
names start with the operator id from the survey inventory.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills the registry
    from weft.plans import (q_history, q_align, q_tokens, q_split, q_clean,  # noqa: F401
                            q_metrics, q_eval, q_io, q_stages)


def entries() -> dict[str, Entry]:
    _load_all()
    return dict(_REGISTRY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.build for k, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in entries().items() if e.sql}


def lit(s: str) -> str:
    """SQL string literal (newlines kept as-is)."""
    return "'" + s.replace("'", "''") + "'"
