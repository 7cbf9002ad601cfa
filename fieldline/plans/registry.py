"""Registry of named queries over the driver tables and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldline.plans.views import PITCH_VIEW_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional SQL oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def with_pitches(*ctes: str, body: str) -> str:
    """Oracle SQL helper: the pitch view CTE, further CTEs, then the final SELECT."""
    parts = [PITCH_VIEW_SQL.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def load_all() -> None:
    """Import every module that registers queries."""
    from fieldline.plans import (  # noqa: F401
        q_features,
        q_history,
        q_jobs,
        q_maintenance,
        q_relational,
        q_sources,
    )
