"""Table schemas, vocabularies and method parameters.

Prices are exact decimals. Derived factors are DECIMAL(38, 18), Spark's widest
type; adjusted price levels are doubles (about 16 significant digits).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 4)
MONEY = T.DecimalType(24, 4)
SHARES = T.DecimalType(24, 4)
DIVIDEND = T.DecimalType(30, 16)
FACTOR = T.DecimalType(38, 18)
FLAGS = T.ArrayType(T.StringType(), containsNull=False)

# ---- fixed values: vocabularies -------------------------------------------
TRADING_STATUSES = ("traded", "no_regular_market_trade", "unknown")
ROW_FLAGS = ("non_regular_activity_present", "unverified_trading_date")
KEY_FLAGS = ("source_ticker_column_mismatch",)
INDEX_FLAGS = ("unverified_trading_date",)
RUN_STATUSES = ("running", "succeeded", "failed")
# What becomes of a row of a run.
ROW_OUTCOMES = (
    "rows_collapsed_duplicates",
    "rows_conflicted",
    "rows_inserted",
    "rows_rejected",
    "rows_unchanged",
)
INCIDENT_TYPES = (
    "conflicting_observation",
    "conflicting_duplicate_in_snapshot",
    "hard_invalid_record",
    "source_ticker_column_mismatch",
    "snapshot_content_mismatch",
    "malformed_optional_field",
)
INCIDENT_STATUSES = ("open", "resolved", "accepted")
INCIDENT_SEVERITIES = ("error", "warning", "info")
IDENTITY_KINDS = ("development",)
SECURITY_MATCHES = ("ticker_text_match", "unmatched")
AMOUNT_BASES = ("gross", "net", "unstated")
FACTOR_KINDS = ("price", "cash_dividend")
FACTOR_CLASSIFICATIONS = (
    "split",
    "reverse_split",
    "rights",
    "bonus",
    "stock_dividend",
    "unclassified",
    "cash_dividend",
)
FACTOR_STATUSES = ("applied", "excluded_market_wide_anomaly")
FILE_ROLES = ("stock", "index", "preview", "other")

# ---- fixed values: names of the rules that stored rows must keep ------------
ROW_RULES = (
    "ohlc_relationship",
    "non_positive_price",
    "negative_volume_value_frequency",
    "invalid_trading_status",
    "status_inconsistent_with_volume",
    "zero_volume_with_open_high_low",
    "invalid_row_flags",
    "unsorted_or_duplicate_row_flags",
)
PLACE_RULES = (
    "price_from_unregistered_or_non_stock_file",
    "price_file_key_differs_from_security_key",
    "price_without_source_key",
    "price_from_unsuccessful_run",
    "file_snapshot_of_other_source",
)

# ---- fixed values: event categories and the label each one gives a factor --
SAME_DAY_LABELS = {"stockSplit": "split", "reverseStock": "reverse_split"}
LISTING_LAG_LABELS = {
    "hmetd": "rights",
    "sahamBonus": "bonus",
    "dividenSaham": "stock_dividend",
}

# ---- fixed values: column groups -------------------------------------------
PRICE_KEY = ("source_id", "security_id", "trading_date")
PRICE_OBSERVATION = (
    "open",
    "high",
    "low",
    "close",
    "reference_price",
    "volume",
    "value",
    "frequency",
    "trading_status",
    "quality_flags",
)
PRICE_PROVENANCE = ("file_id", "source_line")
INDEX_KEY = ("index_code", "trading_date")
INDEX_OBSERVATION = (
    "previous",
    "high",
    "low",
    "close",
    "constituents",
    "volume",
    "value",
    "frequency",
    "capitalization",
    "quality_flags",
)
EVENT_KEY = ("source_record_id",)
EVENT_OBSERVATION = (
    "source_category",
    "source_action_label",
    "source_ticker",
    "registration_date",
    "shares_involved",
    "shares_after",
)
DIVIDEND_KEY = ("source_ticker", "ex_date")
DIVIDEND_OBSERVATION = (
    "amount",
    "amount_basis",
    "currency",
    "dividend_type",
    "fiscal_year",
    "payment_date",
)
FACTOR_KEY = ("security_id", "effective_date", "factor_kind")
FACTOR_COMPARED = (
    "factor",
    "classification",
    "status",
    "reference_price",
    "close",
    "prev_trading_date",
    "prev_close",
    "dividend_amount",
    "source_ex_date",
    "corporate_action_event_id",
    "file_id",
    "source_line",
    "prev_file_id",
    "prev_source_line",
)


@dataclass(frozen=True)
class FactorMethod:
    """Parameters of factor derivation; the defaults are the published method."""

    version: str = "ref-v1"
    market_wide_share: Decimal = Decimal("0.05")
    listing_lag_days: int = 28


# ---- fixed values: table and column names ------------------------------------
TABLES: dict[str, str] = {
    "data_sources": ("source_id STRING, source_name STRING, homepage_url STRING"),
    "source_snapshots": (
        "snapshot_id STRING, source_id STRING, source_revision STRING, content_sha256 STRING, "
        "archive_sha256 STRING, source_url STRING, retrieved_at TIMESTAMP, "
        "licence_reference STRING, raw_storage_path STRING, file_count INT"
    ),
    "source_files": (
        "file_id BIGINT, snapshot_id STRING, relative_path STRING, sha256 STRING, "
        "row_count INT, source_key STRING"
    ),
    "ingestion_runs": (
        "ingestion_run_id STRING, snapshot_id STRING, parser_version STRING, "
        "started_at TIMESTAMP, completed_at TIMESTAMP, status STRING, rows_seen BIGINT, "
        "rows_inserted BIGINT, rows_unchanged BIGINT, rows_rejected BIGINT, "
        "rows_conflicted BIGINT, validation_summary STRING, version BIGINT"
    ),
    "securities": (
        "security_id BIGINT, ticker STRING, name STRING, currency STRING, "
        "identity_kind STRING, version BIGINT"
    ),
    "security_source_keys": (
        "source_id STRING, source_key STRING, security_id BIGINT, "
        "first_seen_snapshot_id STRING, quality_flags ARRAY<STRING>, version BIGINT"
    ),
    "daily_prices": (
        "security_id BIGINT, trading_date DATE, open DECIMAL(20,4), high DECIMAL(20,4), "
        "low DECIMAL(20,4), close DECIMAL(20,4), reference_price DECIMAL(20,4), "
        "volume BIGINT, value DECIMAL(24,4), frequency BIGINT, trading_status STRING, "
        "quality_flags ARRAY<STRING>, file_id BIGINT, source_line INT, "
        "ingestion_run_id STRING, source_id STRING"
    ),
    "data_quality_incidents": (
        "fingerprint STRING, ingestion_run_id STRING, incident_type STRING, severity STRING, "
        "status STRING, security_id BIGINT, trading_date DATE, file_id BIGINT, "
        "source_line INT, details STRING, source_id STRING"
    ),
    "corporate_action_events": (
        "event_id BIGINT, source_record_id STRING, source_category STRING, "
        "source_action_label STRING, source_ticker STRING, security_id BIGINT, "
        "security_match STRING, registration_date DATE, shares_involved DECIMAL(24,4), "
        "shares_after DECIMAL(24,4), file_id BIGINT, record_ref STRING, "
        "ingestion_run_id STRING, source_id STRING"
    ),
    "cash_dividends": (
        "dividend_id BIGINT, source_ticker STRING, ex_date DATE, security_id BIGINT, "
        "security_match STRING, amount DECIMAL(30,16), amount_basis STRING, currency STRING, "
        "dividend_type STRING, fiscal_year INT, payment_date DATE, file_id BIGINT, "
        "record_ref STRING, ingestion_run_id STRING, source_id STRING"
    ),
    "adjustment_builds": (
        "build_id STRING, price_source_id STRING, method_version STRING, parameters STRING, "
        "inputs STRING, summary STRING, built_at TIMESTAMP"
    ),
    "price_adjustment_factors": (
        "security_id BIGINT, effective_date DATE, factor_kind STRING, build_id STRING, "
        "factor DECIMAL(38,18), classification STRING, status STRING, "
        "reference_price DECIMAL(20,4), close DECIMAL(20,4), prev_trading_date DATE, "
        "prev_close DECIMAL(20,4), dividend_amount DECIMAL(30,16), source_ex_date DATE, "
        "corporate_action_event_id BIGINT, file_id BIGINT, source_line INT, "
        "prev_file_id BIGINT, prev_source_line INT, price_source_id STRING, "
        "method_version STRING"
    ),
    "reference_price_anomaly_dates": (
        "trading_date DATE, build_id STRING, mismatched_securities BIGINT, "
        "compared_securities BIGINT, shifted_row_matches BIGINT, price_source_id STRING, "
        "method_version STRING"
    ),
    "index_daily_values": (
        "index_code STRING, trading_date DATE, previous DECIMAL(20,4), high DECIMAL(20,4), "
        "low DECIMAL(20,4), close DECIMAL(20,4), constituents INT, volume BIGINT, "
        "value DECIMAL(24,4), frequency BIGINT, capitalization DECIMAL(24,4), "
        "quality_flags ARRAY<STRING>, file_id BIGINT, source_line INT, "
        "ingestion_run_id STRING, source_id STRING"
    ),
}



def table_schema(table: str) -> T.StructType:
    """Declared schema of a table (needs a running session)."""
    return T.StructType.fromDDL(TABLES[table])


# Tables whose files are laid out by these columns (pruned on read, replaced
# partition by partition when a derived scope is rebuilt).
PARTITIONED_BY: dict[str, tuple[str, ...]] = {
    "daily_prices": ("source_id",),
    "data_quality_incidents": ("source_id",),
    "corporate_action_events": ("source_id",),
    "cash_dividends": ("source_id",),
    "index_daily_values": ("source_id",),
    "price_adjustment_factors": ("price_source_id", "method_version"),
    "reference_price_anomaly_dates": ("price_source_id", "method_version"),
}
