"""The engine's tables derived from the benchmark tables.

Each table is computed by Spark from the whole input and written once per
session to the shared folder, the way a load would leave it; queries then read
stored tables. `FIXTURES.md` part B lists the rules.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators import histories, ordered
from tickerloom.operators.ordered import CHUNK, by_chunks, with_lags, with_row_number
from tickerloom.plans.durable import durable, shared_folder
from tickerloom.plans.folders import remove_at_end
from tickerloom.plans.store import Store
from tickerloom.schemas import DIVIDEND, MONEY, PRICE

SOURCE = "bench"
RUN = "run-1"
_WRITTEN: set[tuple[str, str, str]] = set()

# Event category by order priority.
CATEGORIES = {
    "1-URGENT": "stockSplit",
    "2-HIGH": "reverseStock",
    "3-MEDIUM": "hmetd",
    "4-NOT SPECIFIED": "sahamBonus",
    "5-LOW": "dividenSaham",
}


def dec(text: str, precision: int, scale: int) -> Column:
    return F.lit(text).cast(f"decimal({precision},{scale})")


class Tables:
    """Input tables and derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        tag = hashlib.sha256(self.sf_dir.encode()).hexdigest()[:12]
        app = spark.sparkContext.applicationId
        self.store = Store(spark, f"{shared_folder(spark)}/derived-{app}-{tag}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        mark = (self.spark.sparkContext.applicationId, self.store.root, name)
        if mark not in _WRITTEN:
            self.store.append(name, build())
            remove_at_end(self.spark, self.store.root)
            _WRITTEN.add(mark)
        return self.store.read(name)

    def written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived input that is not an engine table, written once per session."""
        path = f"{self.store.root}/_inputs/{name}"
        mark = (self.spark.sparkContext.applicationId, self.store.root, name)
        if mark not in _WRITTEN:
            build().write.mode("overwrite").parquet(path)
            remove_at_end(self.spark, self.store.root)
            _WRITTEN.add(mark)
        return self.spark.read.parquet(path)

    @property
    def bars(self) -> DataFrame:
        return self._stored("daily_prices", lambda: derive_bars(self.table("lineitem")))

    @property
    def numbered_bars(self) -> DataFrame:
        """Bars with ``rn``, the position within the security (source line - 1)."""
        return self.bars.withColumn("rn", F.col("source_line").cast("bigint") - 1)

    @property
    def events(self) -> DataFrame:
        return self._stored(
            "corporate_action_events",
            lambda: derive_events(self.table("orders"), self.table("supplier").count()),
        )

    @property
    def dividends(self) -> DataFrame:
        return self._stored(
            "cash_dividends",
            lambda: derive_dividends(self.table("orders"), self.table("supplier").count()),
        )

    @property
    def index_values(self) -> DataFrame:
        return self._stored(
            "index_daily_values",
            lambda: derive_index_values(
                self.table("lineitem"),
                self.table("supplier"),
                self.table("nation"),
                self.table("region"),
            ),
        )


def derive_bars(lineitem: DataFrame) -> DataFrame:
    """One bar per supplier and ship date, with planted gaps and discontinuities."""
    rows = lineitem.select(
        F.col("l_suppkey").alias("security_id"),
        F.to_date("l_shipdate").alias("trading_date"),
        "l_extendedprice",
        "l_quantity",
    )
    # Histories lie whole in a task, and are scanned once, unless a security has too many lines.
    lines, numbered_with_lags = histories.dealt(rows, ["security_id"], "trading_date"), histories.numbered_with_lags
    if lines is None:
        lines = by_chunks(rows, ["security_id"], "trading_date")
        numbered_with_lags = ordered.numbered_with_lags
    # Rows move once, as numbers of 8 bytes; days, positions and lags are made where they lie.
    price = F.col("l_extendedprice").cast(PRICE)
    daily = lines.groupBy("security_id", CHUNK, "trading_date").agg(
        F.max("l_extendedprice").cast(PRICE).alias("_high"),
        F.min("l_extendedprice").cast(PRICE).alias("_low"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("_volume"),
        F.sum(price).cast(MONEY).alias("_value"),
        F.count(F.lit(1)).alias("_frequency"),
    )
    daily = daily.withColumn(
        "close", ((F.col("_high") + F.col("_low")) * dec("0.5", 2, 1)).cast(PRICE)
    )
    lagged = numbered_with_lags(
        daily, ["security_id"], "trading_date", "rn", {"pc": ("close", 1), "pc2": ("close", 2)}
    )
    sid, rn = F.col("security_id"), F.col("rn")
    dn = F.datediff("trading_date", F.lit("1995-01-01").cast("date"))
    halted = (sid + rn) % 11 == 0
    traded = ~halted
    reference = (
        F.when(F.col("pc").isNull(), F.col("close"))
        .when(
            (dn % 100 == 0) & (sid % 4 == 0),
            F.coalesce("pc2", (F.col("pc") * dec("0.9", 2, 1)).cast(PRICE)),
        )
        .when((sid * 7 + rn) % 97 == 0, (F.col("pc") * dec("0.2", 2, 1)).cast(PRICE))
        .when((sid * 5 + rn) % 151 == 0, (F.col("pc") * dec("0.8", 2, 1)).cast(PRICE))
        .otherwise(F.col("pc"))
    )
    return lagged.select(
        "security_id",
        "trading_date",
        F.when(traded & ((sid + rn) % 3 != 0), F.col("_low")).alias("open"),
        F.when(traded, F.col("_high")).alias("high"),
        F.when(traded, F.col("_low")).alias("low"),
        "close",
        reference.alias("reference_price"),
        F.when(traded, F.col("_volume")).otherwise(0).alias("volume"),
        F.when(traded, F.col("_value")).otherwise(0).alias("value"),
        F.when(traded, F.col("_frequency")).otherwise(0).alias("frequency"),
        F.when(traded, "traded").otherwise("no_regular_market_trade").alias("trading_status"),
        F.array_compact(
            F.array(
                F.when((sid + rn) % 7 == 0, "non_regular_activity_present"),
                F.when(F.weekday("trading_date") >= 5, "unverified_trading_date"),
            )
        ).alias("quality_flags"),
        (sid + 1).alias("file_id"),
        (rn + 1).cast("int").alias("source_line"),
        F.lit(RUN).alias("ingestion_run_id"),
        F.lit(SOURCE).alias("source_id"),
    )


def derive_events(orders: DataFrame, securities: int) -> DataFrame:
    """One event per order, spread over all securities."""
    labels = F.create_map(*[F.lit(x) for kv in CATEGORIES.items() for x in kv])
    sid = F.col("o_custkey") % securities
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderkey").cast("string").alias("source_record_id"),
        labels[F.col("o_orderpriority")].alias("source_category"),
        F.col("o_orderpriority").alias("source_action_label"),
        F.concat(F.lit("S"), sid.cast("string")).alias("source_ticker"),
        sid.alias("security_id"),
        F.lit("ticker_text_match").alias("security_match"),
        F.to_date("o_orderdate").alias("registration_date"),
        F.lit(1).alias("file_id"),
        F.lit(RUN).alias("ingestion_run_id"),
        F.lit(SOURCE).alias("source_id"),
    )


def derive_dividends(orders: DataFrame, securities: int) -> DataFrame:
    """One dividend per order, spread over all securities."""
    key = F.col("o_orderkey")
    sid = F.col("o_custkey") % securities
    shift = F.when(key % 4 == 3, -30).when(key % 4 == 1, 120).otherwise(0)
    amount = (F.col("o_totalprice").cast("decimal(18,2)") * dec("0.0001", 5, 4)).cast(
        "decimal(18,2)"
    )
    return orders.select(
        key.alias("dividend_id"),
        F.concat(F.lit("S"), sid.cast("string")).alias("source_ticker"),
        F.date_add(F.to_date("o_orderdate"), shift).alias("ex_date"),
        sid.alias("security_id"),
        F.lit("ticker_text_match").alias("security_match"),
        amount.cast(DIVIDEND).alias("amount"),
        F.lit("unstated").alias("amount_basis"),
        F.lit("IDR").alias("currency"),
        F.lit("final").alias("dividend_type"),
        F.lit(1).alias("file_id"),
        F.lit(RUN).alias("ingestion_run_id"),
        F.lit(SOURCE).alias("source_id"),
    )


def derive_index_values(
    lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """One index per region: summed prices per ship date.

    Lines are summed per supplier and date before they meet the dimension tables.
    """
    daily = (
        lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("trading_date"))
        .agg(F.sum(F.col("l_extendedprice").cast(PRICE)).alias("close"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("index_code"), "trading_date")
        .agg(F.sum("close").cast(PRICE).alias("close"))
    )
    numbered = with_row_number(durable(daily), ["index_code"], "trading_date", "rn")
    lagged = with_lags(numbered, ["index_code"], "trading_date", {"pc": ("close", 1)})
    close = F.col("close")
    previous = F.coalesce(
        F.when(F.col("rn") % 50 == 0, (F.col("pc") * dec("0.99", 3, 2)).cast(PRICE)).otherwise(
            F.col("pc")
        ),
        close,
    )
    return lagged.withColumn("previous", previous).select(
        "index_code",
        "trading_date",
        "previous",
        (F.greatest("close", "previous") * dec("1.01", 3, 2)).cast(PRICE).alias("high"),
        (F.least("close", "previous") * dec("0.99", 3, 2)).cast(PRICE).alias("low"),
        "close",
        F.array_compact(
            F.array(F.when(F.weekday("trading_date") >= 5, "unverified_trading_date"))
        ).alias("quality_flags"),
        F.lit(1).alias("file_id"),
        (F.col("rn") + 1).cast("int").alias("source_line"),
        F.lit(RUN).alias("ingestion_run_id"),
        F.lit(SOURCE).alias("source_id"),
    )


def with_errors(bars: DataFrame) -> DataFrame:
    """Numbered bars with planted violations of every row rule."""
    sid, rn = F.col("security_id"), F.col("rn")

    def every(a: int, b: int, n: int) -> Column:
        return (sid * a + rn * b) % n == 0

    flags = F.col("quality_flags")
    return bars.withColumns(
        {
            "volume": F.when(every(3, 1, 101), -1 - F.col("volume")).otherwise(F.col("volume")),
            "high": F.when(every(1, 2, 103), (F.col("low") - 1).cast(PRICE)).otherwise(F.col("high")),
            "open": F.when(every(1, 3, 107), (F.col("high") + 1).cast(PRICE)).otherwise(F.col("open")),
            "close": F.when(every(2, 1, 109), F.lit(0).cast(PRICE)).otherwise(F.col("close")),
            "value": F.when(every(1, 11, 137), None).otherwise(F.col("value")),
            "reference_price": F.when(
                every(1, 13, 139), (-F.col("reference_price")).cast(PRICE)
            ).otherwise(F.col("reference_price")),
            "trading_status": F.when(every(1, 5, 113), "unknown")
            .when(every(1, 1, 127), "traded")
            .when(every(1, 7, 131), "halted")
            .otherwise(F.col("trading_status")),
            "quality_flags": F.when(every(1, 17, 149), F.array_append(flags, "made_up"))
            .when(
                every(1, 19, 151), F.array_append(F.reverse(flags), "unverified_trading_date")
            )
            .when(every(1, 23, 157), F.array_append(flags, F.lit(None).cast("string")))
            .otherwise(flags),
            "source_line": F.when(rn % 211 == 0, 2).otherwise(F.col("source_line")),
            "ingestion_run_id": F.when(sid % 31 == 0, "run-2").otherwise(F.lit(RUN)),
        }
    )


def derive_files(supplier: DataFrame, bars: DataFrame) -> DataFrame:
    """One registered file per supplier, some missing, foreign or not stock files."""
    sid = F.col("s_suppkey")
    rows = bars.groupBy(F.col("security_id").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))
    return (
        supplier.filter(sid % 17 != 0)
        .join(rows, "s_suppkey", "left")
        .select(
            (sid + 1).alias("file_id"),
            F.when(sid % 37 == 0, "other:r1:0").otherwise("bench:r1:0").alias("snapshot_id"),
            F.concat(F.lit("dataset/stocks/csv/S"), sid.cast("string"), F.lit(".csv")).alias(
                "relative_path"
            ),
            F.sha2(F.concat(F.lit("file"), sid.cast("string")), 256).alias("sha256"),
            (F.coalesce("n", F.lit(0)) - F.when(sid % 9 == 0, 1).otherwise(0)).cast("int").alias(
                "row_count"
            ),
            F.when(
                sid % 13 != 0,
                F.concat(F.when(sid % 19 == 0, "X").otherwise("S"), sid.cast("string")),
            ).alias("source_key"),
        )
    )


def derive_keys(supplier: DataFrame) -> DataFrame:
    """One source key per supplier, some missing or with an unknown flag."""
    sid = F.col("s_suppkey")
    return supplier.filter(sid % 23 != 0).select(
        F.lit(SOURCE).alias("source_id"),
        F.concat(F.lit("S"), sid.cast("string")).alias("source_key"),
        sid.alias("security_id"),
        F.lit("bench:r1:0").alias("first_seen_snapshot_id"),
        F.when(sid % 29 == 0, F.array(F.lit("made_up")))
        .when(sid % 7 == 0, F.array(F.lit("source_ticker_column_mismatch")))
        .otherwise(F.array().cast("array<string>"))
        .alias("quality_flags"),
    )


def derive_securities(supplier: DataFrame) -> DataFrame:
    sid = F.col("s_suppkey")
    return supplier.select(
        sid.alias("security_id"),
        F.concat(F.when(sid % 41 == 0, "T").otherwise("S"), sid.cast("string")).alias("ticker"),
        F.col("s_name").alias("name"),
        F.lit("IDR").alias("currency"),
        F.when(sid % 43 == 0, "isin").otherwise("development").alias("identity_kind"),
    )


def derive_snapshots(customer: DataFrame) -> DataFrame:
    """One snapshot per customer: source by segment, revision by nation."""
    key = F.col("c_custkey")
    content = F.sha2(key.cast("string"), 256)
    source = F.lower("c_mktsegment")
    revision = F.concat(F.lit("r"), F.col("c_nationkey").cast("string"))
    derived = F.concat_ws(":", source, revision, F.substring(content, 1, 16))
    return customer.select(
        key.alias("snapshot_key"),
        F.when(key % 50 == 0, F.concat(derived, F.lit("x"))).otherwise(derived).alias("snapshot_id"),
        F.when(key % 60 == 0, F.upper(source)).otherwise(source).alias("source_id"),
        revision.alias("source_revision"),
        F.when(key % 70 == 0, F.upper(content)).otherwise(content).alias("content_sha256"),
        F.when(key % 80 == 0, "short").alias("archive_sha256"),
        F.when(key % 90 == 0, -1).otherwise(key % 100).cast("int").alias("file_count"),
    )


def derive_runs(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One run per order over the snapshot of its customer."""
    key = F.col("o_orderkey")
    started = F.col("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "O", "running")
        .when(F.col("o_orderstatus") == "F", "succeeded")
        .otherwise("failed")
    )
    seen = key % 1000
    collapsed = F.when(key % 3 == 0, key % 7)
    inserted = seen - F.coalesce(collapsed, F.lit(0)) - F.when(key % 111 == 0, 1).otherwise(0)
    snapshots = derive_snapshots(customer).select("snapshot_key", "snapshot_id")
    return (
        orders.join(snapshots, F.col("o_custkey") == F.col("snapshot_key"))
        .select(
            key.cast("string").alias("ingestion_run_id"),
            "snapshot_id",
            F.when(key % 2 == 0, "stock-csv-1").otherwise("index-csv-1").alias("parser_version"),
            started.alias("started_at"),
            F.when((status != "running") | (key % 120 == 0), F.date_add(started, F.when(key % 130 == 0, -1).otherwise(1)).cast("timestamp")).alias(
                "completed_at"
            ),
            status.alias("status"),
            seen.alias("rows_seen"),
            inserted.alias("rows_inserted"),
            F.lit(0).alias("rows_unchanged"),
            F.lit(0).alias("rows_rejected"),
            F.lit(0).alias("rows_conflicted"),
            F.when(
                collapsed.isNotNull(),
                F.to_json(
                    F.struct(
                        F.struct(collapsed.alias("rows_collapsed_duplicates")).alias("counters")
                    )
                ),
            ).alias("validation_summary"),
        )
    )
