"""Queries by key, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.catalog import views

Run = Callable[[SparkSession, str], DataFrame]
AREAS = ["sources", "shape", "joins", "profiles", "windows", "features", "evaluation", "streams", "models"]


@dataclass(frozen=True)
class Query:
    key: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def with_views(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the named views (and further named selects) in front of it."""
    parts = [f"{name} AS ({views.SQL[name]})" for name in names]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}"


def query(
    key: str,
    sql: str | None = None,
    use: list[str] | None = None,
    extra: dict[str, str] | None = None,
) -> Callable[[Run], Run]:
    """Register a query under ``key``; ``sql`` may use the views named in ``use``."""
    text = None if sql is None else (with_views(use or [], sql, extra) if (use or extra) else sql)

    def add(run: Run) -> Run:
        if key in QUERIES:
            raise KeyError(f"Query registered twice: {key}")
        QUERIES[key] = Query(key, run, text)
        return run

    return add


def load() -> dict[str, Query]:
    for area in AREAS:
        importlib.import_module(f"ledgerlens.catalog.{area}")
    return QUERIES
