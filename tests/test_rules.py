"""Each table rule rejects a bad row and accepts a good one."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row

from tickerloom.functions import validate
from tickerloom.plans import verify
from tickerloom.schemas import TABLES, table_schema

D = Decimal
PRICE = dict(
    security_id=1, trading_date=date(2024, 1, 2), open=D("10"), high=D("12"), low=D("9"), close=D("11"),
    reference_price=D("10"), volume=5_000_000_000, value=D("1"), frequency=1, trading_status="traded",
    quality_flags=["unverified_trading_date"], file_id=1, source_line=2, ingestion_run_id="r", source_id="s",
)
EVENT = dict(
    event_id=1, source_record_id="1", source_category="c", source_action_label="l", source_ticker="A",
    security_id=1, security_match="ticker_text_match", registration_date=date(2024, 1, 2),
    shares_involved=D("1"), shares_after=None, file_id=1, record_ref="x", ingestion_run_id="r", source_id="s",
)
DIVIDEND = dict(
    dividend_id=1, source_ticker="A", ex_date=date(2024, 1, 2), security_id=None, security_match="unmatched",
    amount=D("1"), amount_basis="unstated", currency="IDR", dividend_type="final", fiscal_year=2023,
    payment_date=None, file_id=1, record_ref="x", ingestion_run_id="r", source_id="s",
)
FACTOR = dict(
    security_id=1, effective_date=date(2024, 1, 2), factor_kind="price", build_id="b", factor=D("0.5"),
    classification="split", status="applied", reference_price=D("5"), close=D("5"),
    prev_trading_date=date(2024, 1, 1), prev_close=D("10"), dividend_amount=None, source_ex_date=None,
    corporate_action_event_id=None, file_id=1, source_line=2, prev_file_id=1, prev_source_line=3,
    price_source_id="s", method_version="ref-v1",
)
INDEX = dict(
    index_code="LQ-45", trading_date=date(2024, 1, 2), previous=D("1"), high=D("3"), low=D("1"), close=D("2"),
    constituents=None, volume=1, value=None, frequency=None, capitalization=None, quality_flags=[],
    file_id=1, source_line=2, ingestion_run_id="r", source_id="s",
)
RUN = dict(
    ingestion_run_id="r", snapshot_id="s", parser_version="p", started_at=datetime(2024, 1, 2),
    completed_at=datetime(2024, 1, 3), status="succeeded", rows_seen=1, rows_inserted=1, rows_unchanged=0,
    rows_rejected=0, rows_conflicted=0, validation_summary=None, version=1,
)
SNAPSHOT = dict(
    snapshot_id="s:r:" + "a" * 16, source_id="s", source_revision="r", content_sha256="a" * 64,
    archive_sha256=None, source_url="u", retrieved_at=datetime(2024, 1, 2), licence_reference="l",
    raw_storage_path="p", file_count=1,
)
INCIDENT = dict(
    fingerprint="f", ingestion_run_id="r", incident_type="hard_invalid_record", severity="error", status="open",
    security_id=None, trading_date=None, file_id=None, source_line=None, details="{}", source_id="s",
)

CASES = [
    ("daily_prices", PRICE, validate.price_rules, [
        (dict(open=D("0"), high=D("12")), {"open_positive", "traded_shape"}),
        (dict(close=D("-1")), {"close_positive", "traded_shape"}),
        (dict(volume=None), {"traded_shape"}),
        (dict(high=None), {"traded_shape"}),
        (dict(open=D("13")), {"traded_shape"}),
        (dict(open=None), set()),
        (dict(trading_status="halted"), {"trading_status_vocabulary"}),
        (dict(trading_status="no_regular_market_trade"), {"no_regular_trade_shape"}),
        (dict(trading_status="no_regular_market_trade", open=None, high=None, low=None, volume=0), set()),
        (dict(trading_status="no_regular_market_trade", open=None, high=None, low=None, volume=None),
         {"no_regular_trade_shape"}),
        (dict(quality_flags=["made_up"]), {"quality_flags_vocabulary"}),
        (dict(quality_flags=[None]), {"quality_flags_vocabulary"}),
        (dict(value=D("-1")), {"value_non_negative"}),
        (dict(source_line=0), {"source_line_positive"}),
        (dict(reference_price=None, value=None, frequency=None), set()),
    ]),
    ("corporate_action_events", EVENT, validate.event_rules, [
        (dict(security_match="unmatched"), {"security_match_consistent"}),
        (dict(security_match="guess"), {"security_match_vocabulary"}),
        (dict(shares_after=D("-1")), {"shares_after_non_negative"}),
    ]),
    ("cash_dividends", DIVIDEND, validate.dividend_rules, [
        (dict(amount=D("0")), {"amount_positive"}),
        (dict(amount_basis="other"), {"amount_basis_vocabulary"}),
        (dict(security_id=4), {"security_match_consistent"}),
    ]),
    ("price_adjustment_factors", FACTOR, validate.factor_rules, [
        (dict(factor=D("0")), {"factor_positive"}),
        (dict(classification="cash_dividend"), {"classification_matches_kind"}),
        (dict(dividend_amount=D("1")), {"dividend_amount_iff_dividend"}),
        (dict(prev_close=None), {"price_factor_has_previous_row"}),
        (dict(status="maybe"), {"status_vocabulary"}),
        (dict(factor_kind="cash_dividend", classification="cash_dividend", dividend_amount=D("1"),
              prev_close=None, prev_trading_date=None), set()),
    ]),
    ("index_daily_values", INDEX, validate.index_rules, [
        (dict(high=D("1")), {"high_low_close_shape"}),
        (dict(previous=D("0")), {"values_positive"}),
        (dict(index_code="bad code"), {"index_code_format"}),
        (dict(quality_flags=["non_regular_activity_present"]), {"quality_flags_vocabulary"}),
        (dict(volume=-1), {"counts_non_negative"}),
    ]),
    ("ingestion_runs", RUN, validate.run_rules, [
        (dict(status="running"), {"completion_matches_status"}),
        (dict(completed_at=datetime(2024, 1, 1)), {"completed_after_started"}),
        (dict(rows_seen=-1), {"row_counts_non_negative"}),
        (dict(status="running", completed_at=None), set()),
    ]),
    ("source_snapshots", SNAPSHOT, validate.snapshot_rules, [
        (dict(snapshot_id="s:r:x"), {"snapshot_id_derived"}),
        (dict(archive_sha256="x"), {"archive_sha256_format"}),
        (dict(file_count=-1), {"file_count_non_negative"}),
    ]),
    ("data_quality_incidents", INCIDENT, validate.incident_rules, [
        (dict(incident_type="x"), {"incident_type_vocabulary"}),
        (dict(severity="x"), {"severity_vocabulary"}),
        (dict(source_line=0), {"source_line_positive"}),
    ]),
]


@pytest.mark.parametrize(("table", "base", "rules", "cases"), CASES, ids=[c[0] for c in CASES])
def test_rules(spark, table, base, rules, cases):
    schema = table_schema(table)
    names = [f.name for f in schema]
    data = [tuple((base | change)[n] for n in names) for change in ({}, *[c for c, _ in cases])]
    df = spark.createDataFrame([Row(*d) for d in data], schema).coalesce(1)
    broken = [set(r[0]) for r in df.select(validate.broken_rules(rules())).collect()]
    assert broken == [set(), *[b for _, b in cases]]


def test_every_table_has_a_schema_and_prices_have_no_adjusted_column(spark):
    for table in TABLES:
        assert table_schema(table).fields
    prices = spark.createDataFrame([], table_schema("daily_prices"))
    assert verify.adjustment_columns(prices) == 0
    assert verify.adjustment_columns(prices.withColumnRenamed("close", "adj_close")) == 1
