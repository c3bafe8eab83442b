"""Derive price-adjustment factors, store them, compare them with a stored build.

A price factor exists where the exchange's reference price differs from the
previous close. Dates on which many securities differ at once are anomalies of
the source: their factors are excluded unless the event source has a split that
day. Events only label factors, never change their value. Cash dividends are
reinvested on the ex-date or the next traded day.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.digest import multiset_digest
from tickerloom.functions.returns import dividend_factor, price_factor
from tickerloom.operators.compare import compare_tables, symmetric_difference
from tickerloom.operators.histories import with_lags
from tickerloom.operators.ordered import asof_forward
from tickerloom.plans.durable import durable
from tickerloom.plans.store import Store
from tickerloom.schemas import (
    DIVIDEND,
    FACTOR_COMPARED,
    FACTOR_KEY,
    LISTING_LAG_LABELS,
    SAME_DAY_LABELS,
    FactorMethod,
)

# ------------------------------------------------------------ discontinuities


def with_previous_rows(prices: DataFrame) -> DataFrame:
    """Each row with the date, close and provenance of the security's previous row."""
    return with_lags(
        prices.select(
            "security_id", "trading_date", "close", "reference_price", "file_id", "source_line"
        ),
        ["security_id"],
        "trading_date",
        {
            "prev_trading_date": ("trading_date", 1),
            "prev_close": ("close", 1),
            "prev_file_id": ("file_id", 1),
            "prev_source_line": ("source_line", 1),
            "prev2_close": ("close", 2),
        },
    )


def discontinuities(prices: DataFrame) -> DataFrame:
    """Rows whose reference price differs from the previous close."""
    return with_previous_rows(prices).filter(F.col("reference_price") != F.col("prev_close"))


def compared_by_date(prices: DataFrame) -> DataFrame:
    """Securities per date that have both a reference price and a previous row.

    The rows without a previous row are the first of each security, so this
    needs two small aggregates and no ordered scan.
    """
    has_reference = F.col("reference_price").isNotNull()
    rows = prices.filter(has_reference).groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"))
    # Day and mark of the first row as one number, which is reduced in place: the least of
    # structs would sort every row first. A row without a date comes before all others.
    undated = F.lit(-(1 << 40)).cast("bigint")
    day = F.coalesce(F.unix_date("trading_date").cast("bigint"), undated)
    packed = day * 2 + has_reference.cast("bigint")
    first_day = F.shiftright("f", 1)
    date = F.when(first_day != undated, F.date_from_unix_date(first_day.cast("int")))
    first = (
        prices.groupBy("security_id")
        .agg(F.min(packed).alias("f"))
        .filter(F.pmod("f", F.lit(2)) == 1)
        .groupBy(date.alias("trading_date"))
        .agg((-F.count(F.lit(1))).alias("n"))
    )
    return rows.unionByName(first).groupBy("trading_date").agg(F.sum("n").alias("compared_securities"))


def date_statistics(prices: DataFrame, breaks: DataFrame) -> DataFrame:
    """Per date: mismatching securities, compared securities, shifted-row matches."""
    found = breaks.groupBy("trading_date").agg(
        F.count(F.lit(1)).alias("mismatched_securities"),
        F.count_if(F.col("reference_price") == F.col("prev2_close")).alias("shifted_row_matches"),
    )
    return (
        compared_by_date(prices)
        .filter(F.col("compared_securities") > 0)
        .join(found, "trading_date", "left")
        .select(
            "trading_date",
            F.coalesce("mismatched_securities", F.lit(0)).alias("mismatched_securities"),
            "compared_securities",
            F.coalesce("shifted_row_matches", F.lit(0)).alias("shifted_row_matches"),
        )
    )


def anomaly_dates(statistics: DataFrame, method: FactorMethod) -> DataFrame:
    """Dates on which at least the method's share of compared securities differ."""
    return statistics.filter(
        (F.col("mismatched_securities") > 0)
        & (
            F.col("mismatched_securities")
            >= F.lit(method.market_wide_share) * F.col("compared_securities")
        )
    )


# -------------------------------------------------------------------- events


def _label(column: str, labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[F.col(column)]


def match_events(breaks: DataFrame, events: DataFrame, method: FactorMethod) -> DataFrame:
    """The event that explains each discontinuity: ``(security, date, event_id, label)``.

    A split counts on its own day; rights, bonus and stock dividends count up to
    the listing lag after the ex-date. The nearest event wins, then the lowest id.

    Events are first reduced to one per (security, date, kind). The range test
    becomes an equality on date bins as wide as the window: an event has one bin,
    a discontinuity looks into two, so a pair meets at most once and a bin holds
    at most two events per day.
    """
    width = method.listing_lag_days + 1
    labels = {**SAME_DAY_LABELS, **LISTING_LAG_LABELS}
    known = (
        events.filter(
            F.col("security_id").isNotNull() & F.col("source_category").isin(list(labels))
        )
        .select(
            "security_id",
            F.col("registration_date").alias("_on"),
            F.col("source_category").isin(list(SAME_DAY_LABELS)).alias("_same_day"),
            F.struct("event_id", _label("source_category", labels).alias("label")).alias("_event"),
        )
        .groupBy("security_id", "_on", "_same_day")
        .agg(F.min("_event").alias("_event"))
        .withColumn("_bin", F.floor(F.unix_date("_on") / width))
    )
    day = F.unix_date("trading_date")
    looking = breaks.select(
        "security_id",
        "trading_date",
        F.explode(
            F.sequence(F.floor(day / width), F.floor((day + method.listing_lag_days) / width))
        ).alias("_bin"),
    )
    days = F.datediff("_on", "trading_date")
    return (
        looking.join(known, ["security_id", "_bin"])
        .filter(
            F.when(F.col("_same_day"), days == 0).otherwise(
                days.between(0, method.listing_lag_days)
            )
        )
        .groupBy("security_id", "trading_date")
        .agg(F.min(F.struct(days.alias("days"), "_event.event_id", "_event.label")).alias("m"))
        .select("security_id", "trading_date", "m.event_id", "m.label")
    )


def price_factors(
    breaks: DataFrame, anomalies: DataFrame, events: DataFrame | None, method: FactorMethod
) -> DataFrame:
    """Price factors with classification and status.

    The anomaly table has at most one row per calendar day, so broadcasting it is
    safe; joining by date would otherwise gather whole market days in one task.
    """
    out = breaks
    if events is None:
        out = out.withColumn("event_id", F.lit(None).cast("bigint")).withColumn(
            "label", F.lit(None).cast("string")
        )
    else:
        out = out.join(match_events(breaks, events, method), ["security_id", "trading_date"], "left")
    flagged = anomalies.select("trading_date", F.lit(True).alias("_anomaly"))
    excluded = F.col("_anomaly").isNotNull() & ~F.coalesce(
        F.col("label").isin(list(SAME_DAY_LABELS.values())), F.lit(False)
    )
    return out.join(F.broadcast(flagged), "trading_date", "left").select(
        "security_id",
        F.col("trading_date").alias("effective_date"),
        F.lit("price").alias("factor_kind"),
        price_factor(F.col("reference_price"), F.col("prev_close")).alias("factor"),
        F.coalesce("label", F.lit("unclassified")).alias("classification"),
        F.when(excluded, "excluded_market_wide_anomaly").otherwise("applied").alias("status"),
        "reference_price",
        "close",
        "prev_trading_date",
        "prev_close",
        F.lit(None).cast(DIVIDEND).alias("dividend_amount"),
        F.lit(None).cast("date").alias("source_ex_date"),
        F.col("event_id").alias("corporate_action_event_id"),
        "file_id",
        "source_line",
        "prev_file_id",
        "prev_source_line",
    )


# ----------------------------------------------------------------- dividends


def dividends_by_ex_date(dividends: DataFrame) -> DataFrame:
    """Linked dividends summed per security and ex-date."""
    return (
        dividends.filter(F.col("security_id").isNotNull())
        .groupBy("security_id", "ex_date")
        .agg(F.sum("amount").cast(DIVIDEND).alias("amount"))
    )


def place_dividends(prices: DataFrame, dividends: DataFrame) -> DataFrame:
    """Each dividend with its reinvestment row and whether it can be applied.

    ``outcome`` is ``skipped_before_first_row``, ``skipped_no_traded_row`` or
    ``applied``, tested in that order; ``hit`` is the first traded row on or
    after the ex-date.
    """
    traded = prices.filter(F.col("trading_status") == "traded")
    placed = asof_forward(
        dividends_by_ex_date(dividends),
        traded,
        ["security_id"],
        "ex_date",
        "trading_date",
        ["close", "reference_price", "file_id", "source_line"],
    )
    first_rows = prices.groupBy("security_id").agg(F.min("trading_date").alias("first_date"))
    listed = F.coalesce(F.col("first_date") <= F.col("ex_date"), F.lit(False))
    return placed.join(first_rows, "security_id", "left").withColumn(
        "outcome",
        F.when(~listed, "skipped_before_first_row")
        .when(F.col("hit").isNull(), "skipped_no_traded_row")
        .otherwise("applied"),
    )


def merge_dividends(placed: DataFrame) -> DataFrame:
    """Applied dividends merged per effective date; the earliest ex-date is kept."""
    return (
        placed.filter(F.col("outcome") == "applied")
        .groupBy("security_id", F.col("hit.date").alias("effective_date"))
        .agg(
            F.sum("amount").cast(DIVIDEND).alias("amount"),
            F.min("ex_date").alias("source_ex_date"),
            F.count(F.lit(1)).alias("records"),
            # All merged dividends hit the same row.
            F.min("hit").alias("hit"),
        )
        .select(
            "security_id",
            "effective_date",
            "amount",
            "source_ex_date",
            "records",
            "hit.close",
            "hit.reference_price",
            "hit.file_id",
            "hit.source_line",
        )
    )


def dividend_factors(merged: DataFrame) -> DataFrame:
    """Cash-dividend factor rows in the shape of the factor table."""
    return merged.select(
        "security_id",
        "effective_date",
        F.lit("cash_dividend").alias("factor_kind"),
        dividend_factor(F.col("close"), F.col("amount")).alias("factor"),
        F.lit("cash_dividend").alias("classification"),
        F.lit("applied").alias("status"),
        "reference_price",
        "close",
        F.col("amount").alias("dividend_amount"),
        "source_ex_date",
        "file_id",
        "source_line",
    )


def dividend_counts(placed: DataFrame, merged: DataFrame) -> DataFrame:
    """``(name, n)`` counters of the dividend step."""
    skipped = (
        placed.filter(F.col("outcome") != "applied")
        .groupBy(F.concat(F.lit("dividend."), "outcome").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = merged.agg(
        F.count(F.lit(1)).alias("applied"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records_applied"),
        F.count_if(F.col("effective_date") != F.col("source_ex_date")).alias(
            "postponed_to_next_traded_day"
        ),
        F.count_if(F.col("records") > 1).alias("merged_same_effective_date"),
    )
    names = totals.columns
    pairs = ", ".join(f"'dividend.{c}', `{c}`" for c in names)
    return skipped.unionByName(
        totals.selectExpr(f"stack({len(names)}, {pairs}) AS (name, n)").filter("n > 0")
    )


# --------------------------------------------------------------------- build


@dataclass(frozen=True)
class FactorBuild:
    """Derived tables of one (price source, method)."""

    method: FactorMethod
    price_source_id: str
    event_source_id: str | None
    dividend_source_id: str | None
    factors: DataFrame
    anomalies: DataFrame
    counts: DataFrame

    def summary(self) -> dict[str, object]:
        """Row counts; only aggregates reach the driver."""
        totals = self.factors.agg(
            F.count(F.lit(1)).alias("factor_rows"),
            F.count_distinct("security_id").alias("securities_with_factors"),
        ).first()
        return {
            "anomaly_dates": self.anomalies.count(),
            "factor_rows": totals["factor_rows"],
            "securities_with_factors": totals["securities_with_factors"],
            # One row per counter name: a fixed vocabulary.
            "counts": {r["name"]: r["n"] for r in self.counts.orderBy("name").collect()},
        }

    def digest(self) -> str:
        """Stable digest of all factor rows, whatever their order."""
        names = [*FACTOR_KEY, *FACTOR_COMPARED]
        return multiset_digest(self.factors, [F.col(c) for c in names]).first()["digest"]


def factor_counts(factors: DataFrame) -> DataFrame:
    """Price factors per ``price.<classification>.<status>``."""
    return (
        factors.filter(F.col("factor_kind") == "price")
        .groupBy(F.concat_ws(".", F.lit("price"), "classification", "status").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def derive_factors(
    prices: DataFrame,
    events: DataFrame | None,
    dividends: DataFrame | None,
    *,
    price_source_id: str,
    event_source_id: str | None = None,
    dividend_source_id: str | None = None,
    method: FactorMethod | None = None,
) -> FactorBuild:
    """Factors and anomaly dates of one price source.

    The ordered scan runs once: its rare hits, the placed dividends and the
    factors are checkpointed, and everything after reads only those small tables.
    """
    method = method or FactorMethod()
    own = prices.filter(F.col("source_id") == price_source_id)
    if events is not None and event_source_id is not None:
        events = events.filter(F.col("source_id") == event_source_id)
    if dividends is not None and dividend_source_id is not None:
        dividends = dividends.filter(F.col("source_id") == dividend_source_id)
    breaks = durable(discontinuities(own))
    anomalies = durable(anomaly_dates(date_statistics(own, breaks), method))
    factors = price_factors(breaks, anomalies, events, method)
    counts = None
    if dividends is not None:
        placed = durable(place_dividends(own, dividends))
        merged = merge_dividends(placed)
        counts = dividend_counts(placed, merged)
        factors = factors.unionByName(dividend_factors(merged), allowMissingColumns=True)
    scope = [
        F.lit(price_source_id).alias("price_source_id"),
        F.lit(method.version).alias("method_version"),
    ]
    factors = durable(factors.select("*", *scope))
    price_counts = factor_counts(factors)
    return FactorBuild(
        method,
        price_source_id,
        event_source_id,
        dividend_source_id,
        factors,
        anomalies.select("*", *scope),
        price_counts if counts is None else price_counts.unionByName(counts),
    )


def distinct_succeeded(snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """Distinct snapshots that have a succeeded run."""
    succeeded = runs.filter("status = 'succeeded'")
    return snapshots.join(succeeded, "snapshot_id", "left_semi").select("snapshot_id").distinct()


def succeeded_snapshots(store: Store, source_id: str) -> DataFrame:
    """Distinct snapshots of a source that have a succeeded run."""
    return distinct_succeeded(
        store.read("source_snapshots").filter(F.col("source_id") == source_id),
        store.current("ingestion_runs", ["ingestion_run_id"]),
    )


def write_build(store: Store, build: FactorBuild) -> str:
    """Replace the stored factors of the build's scope and record the build."""
    build_id = str(uuid.uuid4())
    for table, df, order in (
        ("price_adjustment_factors", build.factors, ("security_id", "effective_date", "factor_kind")),
        ("reference_price_anomaly_dates", build.anomalies, ("trading_date",)),
    ):
        store.replace_scope(
            table,
            # Files hold disjoint ranges of keys, so a reader skips those it does not ask for.
            df.withColumn("build_id", F.lit(build_id)).repartitionByRange(*order).sortWithinPartitions(*order),
            {
                "price_source_id": build.price_source_id,
                "method_version": build.method.version,
            },
        )
    sources = {
        "price": build.price_source_id,
        "event": build.event_source_id,
        "dividend": build.dividend_source_id,
    }
    inputs: dict[str, object] = {
        f"{kind}_snapshots": []
        if source is None
        # One id per snapshot of one source.
        else sorted(r["snapshot_id"] for r in succeeded_snapshots(store, source).collect())
        for kind, source in sources.items()
    }
    inputs |= {f"{kind}_source_id": source for kind, source in sources.items()}
    parameters = {**asdict(build.method), "market_wide_share": str(build.method.market_wide_share)}
    summary = {**build.summary(), "factors_digest": build.digest()}
    store.append_rows(
        "adjustment_builds",
        [
            {
                "build_id": build_id,
                "price_source_id": build.price_source_id,
                "method_version": build.method.version,
                "parameters": json.dumps(parameters, sort_keys=True),
                "inputs": json.dumps(inputs, sort_keys=True),
                "summary": json.dumps(summary, sort_keys=True),
                "built_at": datetime.now(UTC),
            }
        ],
    )
    return build_id


def compare_with_stored(store: Store, build: FactorBuild) -> dict[str, int]:
    """Differences between a fresh build and the stored rows of its scope."""
    scope = (F.col("price_source_id") == build.price_source_id) & (
        F.col("method_version") == build.method.version
    )
    stored = store.read("price_adjustment_factors").filter(scope)
    diff = compare_tables(build.factors, stored, FACTOR_KEY, FACTOR_COMPARED).first()
    dates = symmetric_difference(
        build.anomalies.select("trading_date"),
        store.read("reference_price_anomaly_dates").filter(scope).select("trading_date"),
    )
    return {
        "factors_missing": diff["missing"],
        "factors_extra": diff["extra"],
        "factors_differing": diff["observation_differs"],
        "anomaly_dates_differing": dates.count(),
    }
