"""Broadcasts and tasks of tables whose size was looked at first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.plans.durable import durable

#: Narrow rows (a few numbers or dates each) that a task may hold beside its work.
FEW_ROWS = 1 << 20


def checked(df: DataFrame, limit: int = FEW_ROWS) -> DataFrame:
    """`df` computed once, to be broadcast if it has at most `limit` rows, else joined by shuffle."""
    kept = durable(df)
    return F.broadcast(kept) if kept.count() <= limit else kept


#: Rows of a table that a task sorts or gathers: some tens of megabytes.
TASK_ROWS = 250_000


def in_tasks(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """`df` dealt by `keys` to as many tasks as its rows ask for, so that none spills.

    `rows` is the number of rows where it is known.
    """
    found = df.count() if rows is None else rows
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-found // TASK_ROWS))
    return df.repartition(tasks, *keys)


def joined_in_tasks(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, rows: int
) -> DataFrame:
    """`left` joined with `right`, both dealt by `keys` to the tasks that `rows` rows a side ask for."""
    return in_tasks(left, *keys, rows=rows).join(in_tasks(right, *keys, rows=rows), list(keys), how)
