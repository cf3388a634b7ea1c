"""The query catalogue: each operator on the driver tables, with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from viewtide.plans.oracle import VIEWS, with_views

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None
    #: The SQL without the views it uses.
    text: str | None = None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None) -> Callable[[Run], Run]:
    """Register a function of (spark, sf_dir) under ``name``; ``views`` replace the usual ones."""

    def register(run: Run) -> Run:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(run, with_views(sql, views or VIEWS) if sql else None, sql)
        return run

    return register


def load() -> dict[str, Query]:
    """The full catalogue."""
    from viewtide.plans import (  # noqa: F401
        queries_batch,
        queries_events,
        queries_features,
        queries_job,
        queries_kept,
        queries_live,
        queries_quality,
        queries_streams,
        queries_tables,
    )

    return CATALOG
