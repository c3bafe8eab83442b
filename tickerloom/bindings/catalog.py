"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerloom.bindings import (  # noqa: F401
    job_queries,
    load_queries,
    quality_queries,
    registry,
    series_queries,
    structure_queries,
    text_queries,
    verify_queries,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
