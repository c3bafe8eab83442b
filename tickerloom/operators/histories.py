"""Ordered scans of whole histories, for tables in which no key is hot.

Where the largest key fits a task, rows are dealt by key once and scanned as they lie:
nothing crosses a border. A table with a hot key goes to `ordered`, which cuts histories
into chunks. Both give the same rows, those without a key or date included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators import ordered, sizes
from tickerloom.operators.ordered import CHUNK, chunk_of


def _has_all(columns: Sequence[str]) -> Column:
    return ~F.array_contains(F.array(*[F.col(c).isNull() for c in columns]), True)


def dealt(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame | None:
    """`df` in tasks that hold keys whole; None where a key has more rows than a task should.

    All rows of a key have chunk 0. Rows without a key are no history: they keep the
    chunks of their dates, as in `ordered`.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (found["most"] or 0) > sizes.TASK_ROWS:
        return None
    chunk = F.when(_has_all(keys), F.lit(0).cast("bigint")).otherwise(chunk_of(F.col(order)))
    return sizes.in_tasks(df.withColumn(CHUNK, chunk), *keys, rows=found["rows"] or 0)


def _lags(lags: Mapping[str, tuple[str, int]], local: Window) -> list[Column]:
    return [F.lag(column, n).over(local).alias(out) for out, (column, n) in lags.items()]


def with_lags(
    df: DataFrame, keys: Sequence[str], order: str, lags: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """What `ordered.with_lags` adds."""
    rows = dealt(df, keys, order)
    if rows is None:
        return ordered.with_lags(df, keys, order, lags)
    local = Window.partitionBy(*keys, CHUNK).orderBy(order)
    return rows.select(*[F.col(c) for c in df.columns], *_lags(lags, local))


def numbered_with_lags(
    rows: DataFrame, keys: Sequence[str], order: str, name: str, lags: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """What `ordered.numbered_with_lags` adds, to rows that were `dealt`."""
    local = Window.partitionBy(*keys, CHUNK).orderBy(order)
    number = F.when(_has_all([*keys, order]), F.row_number().over(local).cast("bigint"))
    columns = [F.col(c) for c in rows.columns if c != CHUNK]
    return rows.select(*columns, number.alias(name), *_lags(lags, local))


def suffix_products(
    rows: DataFrame,
    steps: DataFrame,
    keys: Sequence[str],
    order: str,
    products: Mapping[str, str],
    same_day: Sequence[str] = (),
) -> DataFrame:
    """What `ordered.suffix_products` gives."""
    factors = sorted(set(products.values()))
    extra = list(dict.fromkeys([*factors, *same_day]))
    union = rows.withColumn("_step", F.lit(0)).unionByName(
        steps.select(*keys, order, *extra).withColumn("_step", F.lit(1)), allowMissingColumns=True
    )
    spread = dealt(union, keys, order)
    if spread is None:
        return ordered.suffix_products(rows, steps, keys, order, products, same_day)
    # A row comes before the step of its own date, so that step is not counted.
    newest_first = Window.partitionBy(*keys, CHUNK).orderBy(F.col(order).desc(), F.col("_step"))
    seen = newest_first.rowsBetween(Window.unboundedPreceding, -1)
    # Nothing is later than a row without a date.
    dated = F.col(order).isNotNull()
    multiplied = {f: F.coalesce(F.when(dated, F.product(f).over(seen)), F.lit(1.0)) for f in factors}
    own = (F.lead("_step").over(newest_first) == 1) & (F.lead(order).over(newest_first) == F.col(order))
    return (
        spread.select(
            *[F.col(c) for c in rows.columns],
            *[multiplied[f].alias(name) for name, f in products.items()],
            *[F.when(own, F.lead(c).over(newest_first)).alias(f"_s_{c}") for c in same_day],
            "_step",
        )
        .filter(F.col("_step") == 0)
        .select(*rows.columns, *products, *[F.col(f"_s_{c}").alias(c) for c in same_day])
    )
