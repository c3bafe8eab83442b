"""Row rules: findings per row, table constraints, integrity predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.schemas import (
    AMOUNT_BASES,
    FACTOR_CLASSIFICATIONS,
    FACTOR_KINDS,
    FACTOR_STATUSES,
    INCIDENT_SEVERITIES,
    INCIDENT_STATUSES,
    INCIDENT_TYPES,
    INDEX_FLAGS,
    ROW_FLAGS,
    RUN_STATUSES,
    SECURITY_MATCHES,
    TRADING_STATUSES,
)

HARD, EXPECTED = "hard_invalid", "expected_source_condition"
OHLC_CODES = (
    "high_below_low",
    "high_below_close",
    "low_above_close",
    "high_below_open",
    "low_above_open",
    "traded_without_range",
    "non_positive_open",
    "non_positive_high",
    "non_positive_low",
    "non_positive_close",
)


def c(name: str) -> Column:
    return F.col(name)


def _hard_price_tests() -> dict[str, Column]:
    """Tests of a price row by code: where one is true, the row is unusable."""
    o, h, low, close = c("open"), c("high"), c("low"), c("close")
    traded = c("trading_status") == "traded"
    ranged = traded & h.isNotNull() & low.isNotNull()
    return {
        "negative_volume": c("volume") < 0,
        "non_positive_open": o <= 0,
        "non_positive_high": h <= 0,
        "non_positive_low": low <= 0,
        "non_positive_close": close <= 0,
        "traded_without_range": traded & (h.isNull() | low.isNull()),
        "high_below_low": ranged & (h < low),
        "high_below_close": ranged & (h < close),
        "low_above_close": ranged & (low > close),
        "high_below_open": ranged & (h < o),
        "low_above_open": ranged & (low > o),
    }


def price_issues() -> Column:
    """Findings of a price row as ``array<struct<code, severity>>``.

    Range relations are tested on traded rows only; a row without a regular trade
    has no range and is an expected condition, not an error.
    """
    expected = {
        "no_regular_market_trade": c("trading_status") == "no_regular_market_trade",
        "unclassified_row": c("trading_status") == "unknown",
        "open_missing": c("open").isNull(),
    }
    found = [
        F.when(test, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))
        for rules, severity in ((_hard_price_tests(), HARD), (expected, EXPECTED))
        for code, test in rules.items()
    ]
    return F.array_compact(F.array(*found))


def hard_codes(issues: Column) -> Column:
    """Codes of the findings that make a row unusable."""
    return F.transform(F.filter(issues, lambda i: i["severity"] == HARD), lambda i: i["code"])


def hard_price_codes() -> Column:
    """`hard_codes` of `price_issues`, whose list is made only for rows that need it."""
    found = reduce(or_, _hard_price_tests().values())
    return F.when(found, hard_codes(price_issues())).otherwise(F.array().cast("array<string>"))


def is_hard_invalid(issues: Column) -> Column:
    return F.exists(issues, lambda i: i["severity"] == HARD)


def has_any_code(issues: Column, codes: Sequence[str]) -> Column:
    return F.exists(issues, lambda i: i["code"].isin(list(codes)))


def flags_within(flags: Column, vocabulary: Sequence[str]) -> Column:
    """Only documented values and no NULL element."""
    allowed = F.array(*[F.lit(v) for v in vocabulary])
    return (F.size(F.array_except(flags, allowed)) == 0) & ~F.exists(flags, lambda f: f.isNull())


def _null_or(column: str, test: Column) -> Column:
    return c(column).isNull() | test


def _implies(condition: Column, test: Column) -> Column:
    return ~condition | test


def _filled(*columns: str) -> Column:
    out = F.lit(True)
    for name in columns:
        out = out & c(name).isNotNull()
    return out


def price_rules() -> dict[str, Column]:
    """Constraints of ``daily_prices``: each must be true. Operands that may be
    NULL are guarded, since a NULL result would let the row pass."""
    rules = {
        f"{name}_positive": _null_or(name, c(name) > 0)
        for name in ("open", "high", "low", "reference_price")
    }
    rules["close_positive"] = c("close").isNotNull() & (c("close") > 0)
    rules |= {
        f"{name}_non_negative": _null_or(name, c(name) >= 0)
        for name in ("volume", "value", "frequency")
    }
    rules["source_line_positive"] = c("source_line") >= 1
    rules["trading_status_vocabulary"] = c("trading_status").isin(list(TRADING_STATUSES))
    rules["traded_shape"] = _implies(
        c("trading_status") == "traded",
        _filled("volume", "high", "low")
        & (c("volume") > 0)
        & (c("high") >= c("low"))
        & c("close").between(c("low"), c("high"))
        & _null_or("open", c("open").between(c("low"), c("high"))),
    )
    rules["no_regular_trade_shape"] = _implies(
        c("trading_status") == "no_regular_market_trade",
        _filled("volume")
        & (c("volume") == 0)
        & c("open").isNull()
        & c("high").isNull()
        & c("low").isNull(),
    )
    rules["quality_flags_vocabulary"] = flags_within(c("quality_flags"), ROW_FLAGS)
    return rules


def _match_rules() -> dict[str, Column]:
    return {
        "security_match_vocabulary": c("security_match").isin(list(SECURITY_MATCHES)),
        "security_match_consistent": (c("security_match") == "unmatched")
        == c("security_id").isNull(),
    }


def event_rules() -> dict[str, Column]:
    return _match_rules() | {
        f"{name}_non_negative": _null_or(name, c(name) >= 0)
        for name in ("shares_involved", "shares_after")
    }


def dividend_rules() -> dict[str, Column]:
    return _match_rules() | {
        "amount_positive": c("amount") > 0,
        "amount_basis_vocabulary": c("amount_basis").isin(list(AMOUNT_BASES)),
    }


def factor_rules() -> dict[str, Column]:
    is_dividend = c("factor_kind") == "cash_dividend"
    return {
        "factor_kind_vocabulary": c("factor_kind").isin(list(FACTOR_KINDS)),
        "classification_vocabulary": c("classification").isin(list(FACTOR_CLASSIFICATIONS)),
        "status_vocabulary": c("status").isin(list(FACTOR_STATUSES)),
        "factor_positive": c("factor") > 0,
        "classification_matches_kind": is_dividend == (c("classification") == "cash_dividend"),
        "dividend_amount_iff_dividend": is_dividend == c("dividend_amount").isNotNull(),
        "price_factor_has_previous_row": _implies(
            c("factor_kind") == "price", _filled("prev_close", "prev_trading_date")
        ),
        "source_line_positive": c("source_line") >= 1,
    }


def anomaly_rules() -> dict[str, Column]:
    return {
        "counts_consistent": (c("mismatched_securities") >= 0)
        & (c("compared_securities") >= c("mismatched_securities"))
    }


def index_rules() -> dict[str, Column]:
    counts = ("constituents", "volume", "value", "frequency", "capitalization")
    non_negative = F.lit(True)
    for name in counts:
        non_negative = non_negative & _null_or(name, c(name) >= 0)
    return {
        "index_code_format": c("index_code").rlike(r"^[A-Za-z0-9-]+\z"),
        "values_positive": F.least("previous", "high", "low", "close") > 0,
        "high_low_close_shape": (c("high") >= c("low")) & c("close").between(c("low"), c("high")),
        "counts_non_negative": non_negative,
        "quality_flags_vocabulary": flags_within(c("quality_flags"), INDEX_FLAGS),
        "source_line_positive": c("source_line") >= 1,
    }


SHA256_PATTERN = r"^[0-9a-f]{64}\z"


def source_rules() -> dict[str, Column]:
    return {"source_id_format": c("source_id").rlike(r"^[a-z0-9][a-z0-9-]*\z")}


def snapshot_rules() -> dict[str, Column]:
    return {
        "content_sha256_format": c("content_sha256").rlike(SHA256_PATTERN),
        "archive_sha256_format": _null_or("archive_sha256", c("archive_sha256").rlike(SHA256_PATTERN)),
        "snapshot_id_derived": c("snapshot_id")
        == F.concat_ws(":", "source_id", "source_revision", F.substring("content_sha256", 1, 16)),
        "file_count_non_negative": c("file_count") >= 0,
    }


def file_rules() -> dict[str, Column]:
    return {
        "sha256_format": c("sha256").rlike(SHA256_PATTERN),
        "row_count_non_negative": c("row_count") >= 0,
    }


def run_rules() -> dict[str, Column]:
    counters = ("rows_seen", "rows_inserted", "rows_unchanged", "rows_rejected", "rows_conflicted")
    non_negative = F.lit(True)
    for name in counters:
        non_negative = non_negative & (c(name) >= 0)
    return {
        "status_vocabulary": c("status").isin(list(RUN_STATUSES)),
        "completion_matches_status": (c("status") == "running") == c("completed_at").isNull(),
        "completed_after_started": _null_or("completed_at", c("completed_at") >= c("started_at")),
        "row_counts_non_negative": non_negative,
    }


def incident_rules() -> dict[str, Column]:
    return {
        "incident_type_vocabulary": c("incident_type").isin(list(INCIDENT_TYPES)),
        "status_vocabulary": c("status").isin(list(INCIDENT_STATUSES)),
        "severity_vocabulary": c("severity").isin(list(INCIDENT_SEVERITIES)),
        "source_line_positive": _null_or("source_line", c("source_line") >= 1),
    }


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that yields NULL counts as broken."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in rules.items()])
    )


def count_broken(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, violations)`` for every rule, from one pass over the rows."""
    names = list(rules)
    counted = df.agg(
        *[F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(n) for n in names]
    )
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counted.selectExpr(f"stack({len(names)}, {pairs}) AS (rule, violations)")
