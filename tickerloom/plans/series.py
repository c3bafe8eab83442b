"""Adjusted price series and index series for all securities at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.returns import index_return, price_return, total_return
from tickerloom.operators.histories import suffix_products
from tickerloom.operators.ordered import with_lags
from tickerloom.schemas import DIVIDEND


def applied_steps(factors: DataFrame) -> DataFrame:
    """Applied factors as one row per security and date."""
    is_price = F.col("factor_kind") == "price"
    return (
        factors.filter(F.col("status") == "applied")
        .groupBy("security_id", F.col("effective_date").alias("trading_date"))
        .agg(
            F.max(F.when(is_price, F.col("factor"))).cast("double").alias("price_factor"),
            F.max(F.when(~is_price, F.col("factor"))).cast("double").alias("dividend_factor"),
            F.max("dividend_amount").alias("dividend_amount"),
        )
        .withColumn(
            "total_factor",
            F.coalesce("price_factor", F.lit(1.0)) * F.coalesce("dividend_factor", F.lit(1.0)),
        )
        .withColumn("price_factor", F.coalesce("price_factor", F.lit(1.0)))
        .drop("dividend_factor")
    )


class AmbiguousScope(ValueError):
    """Factors of several sources or methods where one is needed."""


def marked_reliable(rows: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Rows with ``reliable``: their ``trading_date`` is no anomaly date."""
    flagged = anomalies.select("trading_date", F.lit(True).alias("_anomaly"))
    # At most one anomaly row per calendar day: safe to broadcast.
    joined = rows.join(F.broadcast(flagged), "trading_date", "left")
    return joined.withColumn("reliable", F.col("_anomaly").isNull()).drop("_anomaly")


def adjusted_bars(
    prices: DataFrame,
    factors: DataFrame,
    anomalies: DataFrame,
    source_id: str | None = None,
    method_version: str | None = None,
) -> DataFrame:
    """Raw, price-adjusted and total-return series of every security.

    Tables that hold several sources or methods need `source_id` and `method_version`:
    without them, factors of more than one scope raise, as their mixture is no history.

    A factor dated t multiplies every close before t and never the close of t,
    so the last bar of a security equals its raw close. Adjusted levels contain
    later information: use them for ratios, not as prices known at the time.
    """
    if source_id is None or method_version is None:
        scopes = factors.select("price_source_id", "method_version").distinct().limit(2).collect()
        if len(scopes) > 1:
            raise AmbiguousScope(f"factors of several scopes, e.g. {[tuple(s) for s in scopes]}")
    if source_id is not None:
        prices = prices.filter(F.col("source_id") == source_id)
        factors, anomalies = (
            t.filter(F.col("price_source_id") == source_id) for t in (factors, anomalies)
        )
    if method_version is not None:
        factors, anomalies = (
            t.filter(F.col("method_version") == method_version) for t in (factors, anomalies)
        )
    scanned = suffix_products(
        prices.select("security_id", "trading_date", "close", "reference_price"),
        applied_steps(factors),
        ["security_id"],
        "trading_date",
        {"price_multiplier": "price_factor", "total_multiplier": "total_factor"},
        same_day=["dividend_amount"],
    )
    close, reference = F.col("close"), F.col("reference_price")
    dividend = F.coalesce("dividend_amount", F.lit(0).cast(DIVIDEND))
    return marked_reliable(scanned, anomalies).select(
        "security_id",
        "trading_date",
        close,
        reference,
        price_return(close, reference).alias("price_return"),
        total_return(close, dividend, reference).alias("total_return"),
        dividend.alias("dividend"),
        (close.cast("double") * F.col("price_multiplier")).alias("adj_close"),
        (close.cast("double") * F.col("total_multiplier")).alias("tr_adj_close"),
        "reliable",
    )


def index_bars(values: DataFrame) -> DataFrame:
    """Index returns with a reliability flag.

    A row is reliable when the published previous value equals the close of the
    row before it (the first row counts as continuous) and its date is verified.
    """
    lagged = with_lags(
        values.select(
            "source_id", "index_code", "trading_date", "close", "previous", "quality_flags"
        ),
        ["source_id", "index_code"],
        "trading_date",
        {"_prior": ("close", 1)},
    )
    continuous = F.col("_prior").isNull() | (F.col("previous") == F.col("_prior"))
    unverified = F.array_contains("quality_flags", "unverified_trading_date")
    return lagged.select(
        "source_id",
        "index_code",
        "trading_date",
        "close",
        "previous",
        index_return(F.col("close"), F.col("previous")).alias("index_return"),
        (continuous & ~unverified).alias("reliable"),
    )
