"""Ordered scans that stay parallel when one key is hot.

A window over ``PARTITION BY key ORDER BY date`` puts a key's whole history in
one task. Here a key's history is cut into calendar chunks: the window runs per
(key, chunk), and what crosses a chunk border travels in a small carry table
with one row per (key, chunk). The carry is joined on exactly (key, chunk), the
partitioning the window already has, so the large side is shuffled once.

Dates are unique per key in every table these run on, so a chunk holds at most
``days`` rows of a key, whatever share of the table that key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.sizes import checked, in_tasks

CHUNK_DAYS = 366
#: The column of a row's chunk number while it is scanned.
CHUNK = _CHUNK = "_chunk"


def chunk_of(date: Column, days: int = CHUNK_DAYS) -> Column:
    """Calendar chunk number of a date; later dates never get a lower number."""
    return F.floor(F.unix_date(date) / F.lit(days))


def with_lags(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lags: Mapping[str, tuple[str, int]],
    days: int = CHUNK_DAYS,
) -> DataFrame:
    """Add ``{output: (column, n)}`` lag columns per key in date order."""
    depth = max(n for _, n in lags.values())
    carried = sorted({c for c, _ in lags.values()})
    group = [*keys, _CHUNK]
    chunked = df.withColumn(_CHUNK, chunk_of(F.col(order), days))

    # The last `depth` rows of every chunk, newest first. Ranking before the
    # group keeps the shuffled and collected size at `depth` rows per chunk.
    newest_first = Window.partitionBy(*group).orderBy(F.col(order).desc())
    tails = (
        chunked.select(*dict.fromkeys([*group, order, *carried]))
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= depth)
        .groupBy(*group)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(F.col(order).alias("_o"), *[F.col(c).alias(f"_c_{c}") for c in carried])
                ),
                asc=False,
            ).alias("_tail")
        )
    )
    by_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)
    nothing = F.slice("_tail", 1, 0)
    earlier = [F.coalesce(F.lag("_tail", i).over(by_chunk), nothing) for i in range(1, depth + 1)]
    carry = tails.select(*group, F.slice(F.concat(*earlier), 1, depth).alias("_carry"))

    local = Window.partitionBy(*group).orderBy(order)
    out = chunked.withColumn("_rn", F.row_number().over(local))
    for name, (column, n) in lags.items():
        out = out.withColumn(f"_l_{name}", F.lag(column, n).over(local))
    out = out.join(carry, group, "left")
    values = [
        F.when(F.col("_rn") > n, F.col(f"_l_{name}"))
        .otherwise(F.get("_carry", F.lit(n) - F.col("_rn")).getField(f"_c_{column}"))
        .alias(name)
        for name, (column, n) in lags.items()
    ]
    return out.select(*[F.col(c) for c in df.columns], *values)


def by_chunks(df: DataFrame, keys: Sequence[str], order: str, days: int = CHUNK_DAYS) -> DataFrame:
    """`df` with its chunk number, in tasks of `TASK_ROWS` that hold chunks of keys whole.

    What is grouped by ``(*keys, _chunk)`` and more, or scanned within them, moves no more.
    """
    return in_tasks(df.withColumn(_CHUNK, chunk_of(F.col(order), days)), *keys, _CHUNK)


def numbered_with_lags(
    chunked: DataFrame, keys: Sequence[str], order: str, name: str, lags: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """What `with_row_number` and `with_lags` add, in one scan of rows that lie `by_chunks`.

    `chunked` is scanned twice. The scan for what a chunk hands on keeps whole rows, so
    that Spark sees the same shuffle in both and runs it once.
    """
    depth = max(n for _, n in lags.values())
    group = [*keys, _CHUNK]
    columns = [c for c in chunked.columns if c != _CHUNK]
    local = Window.partitionBy(*group).orderBy(order)
    placed = chunked.withColumn("_rn", F.row_number().over(local))
    # The last `depth` rows of every chunk: no row follows at that distance.
    ends = (
        placed.withColumn("_follows", F.lead(F.lit(1), depth).over(local))
        .filter("_follows IS NULL")
        .groupBy(*group)
        .agg(
            F.max("_rn").alias("_n"),
            F.sort_array(F.collect_list(F.struct("_rn", *columns)), asc=False).alias("_tail"),
        )
    )
    by_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.slice("_tail", 1, 0)
    earlier = [F.coalesce(F.lag("_tail", i).over(by_chunk), nothing) for i in range(1, depth + 1)]
    # A chunk without key or date is handed nothing: its number is one that no date has. Join
    # columns that are never NULL leave the scan below them as it is, without a test of its own.
    types = dict(chunked.dtypes)
    none = F.lit(-(1 << 63)).cast("bigint")
    known = ~F.array_contains(F.array(*[F.col(c).isNull() for c in group]), True)
    carry = ends.select(
        *[F.coalesce(F.col(c), F.lit("0").cast(types[c])).alias(f"_g_{c}") for c in keys],
        F.coalesce(F.when(known, F.col(_CHUNK)), none).alias(f"_g_{_CHUNK}"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.slice(F.concat(*earlier), 1, depth).alias("_carry"),
    )
    same = [F.col(c) == F.col(f"_g_{c}") for c in group]
    for out, (column, n) in lags.items():
        placed = placed.withColumn(f"_l_{out}", F.lag(column, n).over(local))
    values = [
        F.when(F.col("_rn") > n, F.col(f"_l_{out}"))
        .otherwise(F.get("_carry", F.lit(n) - F.col("_rn")).getField(column))
        .alias(out)
        for out, (column, n) in lags.items()
    ]
    return placed.join(carry, same, "left").select(
        *columns, (F.col("_rn") + F.col("_before")).alias(name), *values
    )


def with_row_number(
    df: DataFrame, keys: Sequence[str], order: str, name: str, days: int = CHUNK_DAYS
) -> DataFrame:
    """Add the 1-based position of each row within its key, in date order."""
    group = [*keys, _CHUNK]
    chunked = df.withColumn(_CHUNK, chunk_of(F.col(order), days))
    before = (
        Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        chunked.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    local = Window.partitionBy(*group).orderBy(order)
    return (
        chunked.withColumn("_rn", F.row_number().over(local))
        .join(carry, group, "left")
        .select(*df.columns, (F.col("_rn") + F.col("_before")).alias(name))
    )


def suffix_products(
    rows: DataFrame,
    steps: DataFrame,
    keys: Sequence[str],
    order: str,
    products: Mapping[str, str],
    same_day: Sequence[str] = (),
    days: int = CHUNK_DAYS,
) -> DataFrame:
    """Multiply, for every row, the steps dated strictly after it.

    ``steps`` holds at most one row per (key, date) with the factor columns named
    in ``products`` (``{output: factor column}``) and the columns in ``same_day``,
    which are copied to the row of the same key and date. Rows and steps are
    scanned together, so both reach the window through one shuffle.

    The scan runs newest date first over a frame that only grows. The same frame
    written oldest first would be recomputed for every row.
    """
    group = [*keys, _CHUNK]
    factors = sorted(set(products.values()))
    extra = list(dict.fromkeys([*factors, *same_day]))
    union = (
        rows.withColumn("_step", F.lit(0))
        .unionByName(
            steps.select(*keys, order, *extra).withColumn("_step", F.lit(1)),
            allowMissingColumns=True,
        )
        .withColumn(_CHUNK, chunk_of(F.col(order), days))
    )
    totals = union.groupBy(*group).agg(
        *[F.coalesce(F.product(f), F.lit(1.0)).alias(f"_t_{f}") for f in factors]
    )
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col(_CHUNK).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *group,
        *[F.coalesce(F.product(f"_t_{f}").over(later), F.lit(1.0)).alias(f"_k_{f}") for f in factors],
    )
    # A row comes before the step of its own date, so that step is not counted.
    newest_first = Window.partitionBy(*group).orderBy(F.col(order).desc(), F.col("_step"))
    seen = newest_first.rowsBetween(Window.unboundedPreceding, -1)
    scanned = union.select(
        "*",
        *[F.coalesce(F.product(f).over(seen), F.lit(1.0)).alias(f"_p_{f}") for f in factors],
        *[
            F.when(
                (F.lead("_step").over(newest_first) == 1)
                & (F.lead(order).over(newest_first) == F.col(order)),
                F.lead(c).over(newest_first),
            ).alias(f"_s_{c}")
            for c in same_day
        ],
    ).filter(F.col("_step") == 0)
    return scanned.join(carry, group, "left").select(
        *rows.columns,
        *[
            (F.col(f"_p_{f}") * F.coalesce(F.col(f"_k_{f}"), F.lit(1.0))).alias(name)
            for name, f in products.items()
        ],
        *[F.col(f"_s_{c}").alias(c) for c in same_day],
    )


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_on: str,
    right_on: str,
    take: Sequence[str],
    name: str = "hit",
    days: int = CHUNK_DAYS,
) -> DataFrame:
    """Give each left row the earliest right row dated on or after it.

    The hit is a struct column ``name`` of ``right_on`` and ``take`` (NULL when
    there is none). Of the right side only two kinds of rows are looked at: those in a chunk
    that holds a left row, and the first row of the chunk that follows one. So what is
    shuffled and sorted follows the left side; the right side is scanned, and counted by
    (key, chunk). No pairs are formed.
    """
    group = [*keys, _CHUNK]
    probes = left.select(
        *keys,
        F.col(left_on).alias("_d"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_left"),
    ).withColumn(_CHUNK, chunk_of(F.col("_d"), days))
    rows = right.select(*keys, F.col(right_on).alias("_d"), *take).withColumn(_CHUNK, chunk_of(F.col("_d"), days))
    counted = checked(probes.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")))
    asked = counted.select(*group)
    heads = rows.groupBy(*group).agg(F.min("_d").alias("_head"))
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col(_CHUNK).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row a (key, chunk) on either side.
    following = checked(
        heads.join(asked.withColumn("_asked", F.lit(True)), group, "full_outer")
        .select(*group, "_asked", F.last("_head", ignorenulls=True).over(later).alias("_d"))
        .filter(F.col("_asked") & F.col("_d").isNotNull())
        .drop("_asked")
    )
    within = rows.join(asked, group, "left_semi")
    behind = rows.drop(_CHUNK).join(following, [*keys, "_d"])
    hit = F.struct(F.col("_d").alias("date"), *[F.col(c) for c in take]).alias("_hit")
    seen = within.unionByName(behind).select(*group, "_d", F.lit(0).alias("_side"), hit)
    newest_first = (
        Window.partitionBy(*group)
        .orderBy(F.col("_d").desc(), F.col("_side"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # No more rows can meet: sorted in tasks for them, whatever the session's partitions.
    most = right.count() + (counted.agg(F.sum("_n")).first()[0] or 0)
    return (
        in_tasks(seen.unionByName(probes, allowMissingColumns=True), *group, rows=most)
        .withColumn(name, F.last("_hit", ignorenulls=True).over(newest_first))
        .filter(F.col("_side") == 1)
        .select("_left.*", name)
    )
