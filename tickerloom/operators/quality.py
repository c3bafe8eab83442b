"""Quality reports and stored-table aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.validate import (
    OHLC_CODES,
    has_any_code,
    is_hard_invalid,
    price_issues,
)
from tickerloom.schemas import TRADING_STATUSES


def quality_report(prices: DataFrame, security: str = "security_id") -> DataFrame:
    """One row summarising a price table.

    Rows are folded per (security, date), then per security, then in total. Every
    step combines on the map side; two distinct counts in one aggregate would
    copy each row per count instead.
    """
    issues = F.col("_issues")
    flagged = prices.withColumn("_issues", price_issues())
    per_key = flagged.groupBy(security, "trading_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("open").isNull()).alias("missing_open"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
        F.count_if(has_any_code(issues, OHLC_CODES)).alias("invalid_ohlc"),
        F.count_if(has_any_code(issues, ["negative_volume"])).alias("negative_volume"),
        F.count_if(is_hard_invalid(issues)).alias("hard_invalid_rows"),
    )
    sums = (
        "rows",
        "missing_open",
        "zero_volume",
        "invalid_ohlc",
        "negative_volume",
        "hard_invalid_rows",
    )
    dates = (F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"))
    per_security = per_key.groupBy(security).agg(
        *[F.sum(s).alias(s) for s in sums],
        F.sum(F.col("rows") - 1).alias("duplicates"),
        *dates,
    )
    total = per_security.agg(
        F.count(F.lit(1)).alias("securities"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in (*sums, "duplicates")],
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    return total.withColumn("missing_open_pct", missing_open_pct())


def missing_open_pct():
    """Share of rows without an open, in percent; 0 for an empty table."""
    share = F.try_divide(F.lit(100.0) * F.col("missing_open"), F.col("rows"))
    return F.coalesce(share, F.lit(0.0))


def observation_stats(prices: DataFrame) -> DataFrame:
    """Counts of a price table: rows, gaps, multi-flag rows and the date range."""
    return prices.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("open").isNull()).alias("missing_open"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
        F.count_if(F.size(F.array_distinct("quality_flags")) >= 2).alias("multi_flag_rows"),
        F.min("trading_date").alias("first_date"),
        F.max("trading_date").alias("last_date"),
    )


def status_counts(prices: DataFrame) -> DataFrame:
    """Rows per status, with a zero for statuses that do not occur."""
    counted = prices.agg(
        *[F.count_if(F.col("trading_status") == s).alias(s) for s in TRADING_STATUSES]
    )
    pairs = ", ".join(f"'{s}', `{s}`" for s in TRADING_STATUSES)
    return counted.selectExpr(f"stack({len(TRADING_STATUSES)}, {pairs}) AS (trading_status, n)")


def flag_counts(prices: DataFrame) -> DataFrame:
    """Rows per flag."""
    return (
        prices.select(F.explode("quality_flags").alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def role_counts(files: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Files per role, with a zero for roles that do not occur."""
    counted = files.agg(*[F.count_if(F.col("role") == r).alias(r) for r in roles])
    pairs = ", ".join(f"'{r}', `{r}`" for r in roles)
    return counted.selectExpr(f"stack({len(roles)}, {pairs}) AS (role, files)")
