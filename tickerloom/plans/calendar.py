"""Observed trading calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_weekend(date: str) -> Column:
    """Saturday or Sunday."""
    return F.weekday(date) >= 5


def observed_trading_days(prices: DataFrame, index_values: DataFrame) -> DataFrame:
    """Every date seen in stock or index rows, with row counts per kind.

    Both inputs are counted before they meet, so what is shuffled is one row per
    (source, date) and map task, not the bars.
    """

    def counted(df: DataFrame, stock: bool) -> DataFrame:
        rows = df.groupBy("source_id", "trading_date").agg(F.count(F.lit(1)).alias("n"))
        zero = F.lit(0).cast("bigint")
        return rows.select(
            "source_id",
            "trading_date",
            (F.col("n") if stock else zero).alias("stock_rows"),
            (zero if stock else F.col("n")).alias("index_rows"),
        )

    days = (
        counted(prices, True)
        .unionByName(counted(index_values, False))
        .groupBy("source_id", "trading_date")
        .agg(F.sum("stock_rows").alias("stock_rows"), F.sum("index_rows").alias("index_rows"))
    )
    return days.select(
        "*",
        (F.col("stock_rows") > 0).alias("in_stock_data"),
        (F.col("index_rows") > 0).alias("in_index_data"),
        is_weekend("trading_date").alias("is_weekend"),
    )
