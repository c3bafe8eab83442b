"""Queries by operator id, each with the SQL another engine can check it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.bindings.derived import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    """Name a piece of check SQL; `needs` are the pieces it reads."""
    CTES[name] = (needs, body)


def _with(names: tuple[str, ...]) -> str:
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in ordered:
            return
        needs, body = CTES[name]
        for n in needs:
            visit(n)
        ordered[name] = body

    for n in names:
        visit(n)
    if not ordered:
        return ""
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ordered.items()) + "\n"


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines share: bigint, double, string, date, boolean."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, *needs: str) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under `name`, with its check SQL."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _with(needs) + sql.strip()
        return fn

    return register
