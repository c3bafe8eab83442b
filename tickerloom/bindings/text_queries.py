"""Source readers and normalisation of source text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.bindings import files
from tickerloom.bindings.derived import SOURCE, Tables
from tickerloom.bindings.registry import query
from tickerloom.functions import normalize
from tickerloom.operators.dedupe import accepted, key_groups
from tickerloom.plans.durable import written
from tickerloom.schemas import EVENT_OBSERVATION
from tickerloom.sources import json_records
from tickerloom.sources.adapters import ActionsJsonSource, IndexCsvSource, StockCsvSource
from tickerloom.sources.csv_lines import with_data_row_count

STOCK, INDEX = StockCsvSource(SOURCE), IndexCsvSource(SOURCE)


def stock_rows(t: Tables) -> DataFrame:
    return staged(STOCK.rows(files.stock_files(t)))


def index_rows(t: Tables) -> DataFrame:
    return staged(INDEX.records(files.index_files(t)))


def event_rows(t: Tables) -> DataFrame:
    return staged(json_records.action_records(files.event_files(t)))


def dividend_rows(t: Tables) -> DataFrame:
    return staged(json_records.dividend_records(files.dividend_files(t)))


def staged(rows: DataFrame) -> DataFrame:
    """Parsed rows written once, as a load does.

    A filter on ``reasons`` would otherwise be pushed below the projection and
    parse every cell a second time.
    """
    return written(rows)


def reasons() -> Column:
    return F.array_join("reasons", "|").alias("reason")


# ------------------------------------------------------------------- stock CSV


@query(
    "s9_stock_csv_scan",
    """SELECT k AS source_key, line AS source_line, CAST(CASE WHEN rn % 83 = 0 THEN 2 ELSE 26 END AS BIGINT) AS cells
    FROM stock_lines""",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    rows = stock_rows(t)
    return rows.select("source_key", "source_line", F.size("cells").alias("cells"))


@query(
    "s13_rejected_lines",
    "SELECT k AS source_key, line AS source_line, reason FROM stock_lines WHERE reason IS NOT NULL",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    rows = stock_rows(t).filter(F.size("reasons") > 0)
    return rows.select("source_key", "source_line", reasons())


@query(
    "s10_malformed_lines",
    "SELECT k AS source_key, count(*) AS malformed, min(line) AS first_line FROM stock_lines WHERE rn % 83 = 0 GROUP BY k",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    rows = stock_rows(t)
    wide = normalize.wrong_width(F.col("cells"), 26).isNotNull()
    return rows.filter(wide).groupBy("source_key").agg(
        F.count(F.lit(1)).alias("malformed"), F.min("source_line").alias("first_line")
    )


@query(
    "p8_normalized_rows",
    """SELECT k AS source_key, trading_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
    CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(reference_price AS DOUBLE) AS reference_price,
    CAST(volume AS BIGINT) AS volume, CAST(value AS DOUBLE) AS value, CAST(frequency AS BIGINT) AS frequency,
    trading_status, flags AS quality_flags FROM stock_lines WHERE reason IS NULL""",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    rows = STOCK.rows(files.stock_files(t)).drop("relative_path", "sha256", "source_line", "cells")
    return staged(rows).filter(F.size("reasons") == 0).drop("reasons")


@query(
    "s12_file_facts",
    """SELECT k AS source_key, count(*) AS row_count, max(trading_date) FILTER (WHERE ok) AS newest_date,
    max_by(company, trading_date) FILTER (WHERE ok) AS newest_name,
    CASE WHEN security_id % 6 = 0 AND bool_or(rn % 83 <> 0) THEN lower(k) ELSE '' END AS ticker_mismatch_values
    FROM (SELECT *, rn % 83 <> 0 AND rn % 97 <> 0 AS ok FROM stock_lines) s GROUP BY k, security_id""",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    return STOCK.inspected(files.stock_files(t)).select(
        "source_key", "row_count", "newest_date", "newest_name", "ticker_mismatch_values"
    )


@query(
    "s20_security_listing",
    """SELECT 'dev:bench:' || k AS security_id, max_by(company, trading_date) FILTER (WHERE rn % 83 <> 0 AND rn % 97 <> 0) AS name
    FROM stock_lines GROUP BY k""",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    facts = STOCK.inspected(files.stock_files(t))
    return facts.select(
        STOCK.security_id_text(F.col("source_key")).alias("security_id"),
        F.col("newest_name").alias("name"),
    )


@query(
    "p10_ticker_case_mismatches",
    "SELECT k AS source_key, lower(k) AS ticker FROM stock_lines WHERE security_id % 6 = 0 GROUP BY k HAVING bool_or(rn % 83 <> 0)",
    "stock_lines",
)
def _(t: Tables) -> DataFrame:
    facts = STOCK.inspected(files.stock_files(t))
    return facts.select("source_key", F.explode("ticker_mismatch_values").alias("ticker"))


@query(
    "s11_csv_row_counts",
    """SELECT 'dataset/indices/csv/' || code || '.csv' AS relative_path, count(*) AS row_count FROM index_lines GROUP BY code""",
    "index_lines",
)
def _(t: Tables) -> DataFrame:
    return with_data_row_count(files.index_files(t)).select("relative_path", "row_count")


@query(
    "s7_inventory",
    """SELECT 'stock' AS role, count(*) AS files, CAST(sum(n) AS BIGINT) AS rows, count(DISTINCT k) AS keys
      FROM (SELECT k, count(*) AS n FROM stock_lines GROUP BY k) s
    UNION ALL SELECT 'index', count(*), CAST(sum(n) AS BIGINT), 0 FROM (SELECT code, count(*) AS n FROM index_lines GROUP BY code) i""",
    "stock_lines",
    "index_lines",
)
def _(t: Tables) -> DataFrame:
    both = files.stock_files(t).unionByName(files.index_files(t))
    return (
        STOCK.inspected(both)
        .groupBy("role")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("row_count").alias("rows"),
            F.count("source_key").alias("keys"),
        )
    )


# ------------------------------------------------------------------- index CSV


@query(
    "s14_index_csv_scan",
    """SELECT code AS index_code, line AS source_line, trading_date, CAST(close AS DOUBLE) AS close,
    CAST(high AS DOUBLE) AS high, CAST(900 AS BIGINT) AS constituents,
    CASE WHEN f_weekend THEN 'unverified_trading_date' ELSE '' END AS quality_flags
    FROM index_lines WHERE reason IS NULL""",
    "index_lines",
)
def _(t: Tables) -> DataFrame:
    rows = index_rows(t).filter(F.size("reasons") == 0)
    return rows.select(
        "index_code", "source_line", "trading_date", "close", "high", "constituents", "quality_flags"
    )


@query(
    "p15_index_row_checks",
    "SELECT code AS index_code, line AS source_line, reason FROM index_lines WHERE reason IS NOT NULL",
    "index_lines",
)
def _(t: Tables) -> DataFrame:
    rows = index_rows(t).filter(F.size("reasons") > 0)
    return rows.select("index_code", "source_line", reasons())


@query(
    "p16_provenance_column",
    """SELECT 'line' AS kind, CAST(line AS VARCHAR) AS record_ref, count(*) AS n FROM index_lines GROUP BY line
    UNION ALL SELECT 'text', ref, count(*) FROM event_records GROUP BY ref""",
    "index_lines",
    "event_records",
)
def _(t: Tables) -> DataFrame:
    sides = (
        ("line", INDEX, index_rows(t)),
        ("text", ActionsJsonSource(SOURCE), event_rows(t)),
    )
    parts = [
        rows.groupBy(
            F.lit(kind).alias("kind"),
            F.col(source.kept.place).cast("string").alias("record_ref"),
        ).agg(F.count(F.lit(1)).alias("n"))
        for kind, source, rows in sides
    ]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------------ JSON


@query(
    "s15_event_json_scan",
    "SELECT block, o_orderpriority AS category, count(*) AS records FROM event_records GROUP BY block, o_orderpriority",
    "event_records",
)
def _(t: Tables) -> DataFrame:
    rows = event_rows(t)
    block = F.regexp_extract("relative_path", "block-([0-9]+)/", 1).cast("bigint")
    return rows.groupBy(block.alias("block"), F.col("source_category").alias("category")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "s15_event_structure",
    "SELECT count(DISTINCT block) AS sound_documents FROM event_records",
    "event_records",
)
def _(t: Tables) -> DataFrame:
    docs = files.event_files(t)
    bad = json_records.action_problems(docs).agg((-F.count(F.lit(1))).alias("n"))
    return (
        docs.agg(F.count(F.lit(1)).alias("n"))
        .unionByName(bad)
        .agg(F.sum("n").alias("sound_documents"))
    )


@query(
    "p12_event_records",
    """SELECT ref AS record_ref, CAST(o_orderkey AS VARCHAR) AS source_record_id, day AS registration_date,
    'S' || (o_custkey % 100) AS match_key, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 900 AS DOUBLE) END AS shares_involved,
    CAST(12.5 AS DOUBLE) AS shares_after FROM event_records WHERE reason IS NULL""",
    "event_records",
)
def _(t: Tables) -> DataFrame:
    rows = event_rows(t).filter(F.size("reasons") == 0)
    return rows.select(
        "record_ref",
        "source_record_id",
        "registration_date",
        "match_key",
        "shares_involved",
        "shares_after",
    )


@query(
    "p12_rejected_events",
    "SELECT block, ref AS record_ref, reason FROM event_records WHERE reason IS NOT NULL",
    "event_records",
)
def _(t: Tables) -> DataFrame:
    rows = event_rows(t).filter(F.size("reasons") > 0)
    block = F.regexp_extract("relative_path", "block-([0-9]+)/", 1).cast("bigint")
    return rows.select(block.alias("block"), "record_ref", reasons())


@query(
    "a9_record_outcomes",
    """SELECT count(*) AS records_seen, count(*) FILTER (WHERE reason IS NULL) AS records_accepted,
    count(*) FILTER (WHERE reason IS NOT NULL) AS records_rejected,
    count(*) FILTER (WHERE reason IS NULL) AS records_with_ticker FROM event_records""",
    "event_records",
)
def _(t: Tables) -> DataFrame:
    rows = event_rows(t)
    groups = key_groups(
        rows.filter(F.size("reasons") == 0),
        ["source_record_id"],
        EVENT_OBSERVATION,
        F.struct("relative_path", "position"),
        ["match_key"],
    )
    kept = accepted(groups).agg(
        F.count(F.lit(1)).alias("records_accepted"),
        F.count("match_key").alias("records_with_ticker"),
    )
    seen = rows.agg(
        F.count(F.lit(1)).alias("records_seen"),
        F.count_if(F.size("reasons") > 0).alias("records_rejected"),
    )
    # Two one-row aggregates side by side.
    return seen.withColumn("one", F.lit(1)).join(kept.withColumn("one", F.lit(1)), "one").drop("one")


@query(
    "s16_dividend_json_scan",
    "SELECT block, o_custkey % 100 AS security_id, count(*) AS records FROM dividend_records GROUP BY block, o_custkey % 100",
    "dividend_records",
)
def _(t: Tables) -> DataFrame:
    rows = dividend_rows(t)
    block = F.regexp_extract("relative_path", "block-([0-9]+)/", 1).cast("bigint")
    security = F.regexp_extract("source_ticker", "S([0-9]+)", 1).cast("bigint")
    return rows.groupBy(block.alias("block"), security.alias("security_id")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "p13_dividend_records",
    """SELECT block, ref AS record_ref, 'S' || (o_custkey % 100) AS match_key, day AS ex_date, CAST(amount AS DOUBLE) AS amount,
    year(day) AS fiscal_year, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0 THEN day END AS payment_date
    FROM dividend_records WHERE reason IS NULL""",
    "dividend_records",
)
def _(t: Tables) -> DataFrame:
    rows = dividend_rows(t).filter(F.size("reasons") == 0)
    block = F.regexp_extract("relative_path", "block-([0-9]+)/", 1).cast("bigint")
    return rows.select(
        block.alias("block"),
        "record_ref",
        "match_key",
        "ex_date",
        "amount",
        "fiscal_year",
        "payment_date",
    )


@query(
    "p13_rejected_dividends",
    "SELECT block, ref AS record_ref, reason FROM dividend_records WHERE reason IS NOT NULL",
    "dividend_records",
)
def _(t: Tables) -> DataFrame:
    rows = dividend_rows(t).filter(F.size("reasons") > 0)
    block = F.regexp_extract("relative_path", "block-([0-9]+)/", 1).cast("bigint")
    return rows.select(block.alias("block"), "record_ref", reasons())


@query(
    "p14_optional_date_issues",
    """SELECT block, ref AS record_ref, strftime(day, '%Y-%m-%-d') || 'x' AS raw FROM dividend_records
    WHERE reason IS NULL AND o_orderkey % 3 <> 0 AND o_orderkey % 7 = 0""",
    "dividend_records",
)
def _(t: Tables) -> DataFrame:
    rows = dividend_rows(t).filter(F.size("reasons") == 0)
    block = F.regexp_extract("relative_path", "block-([0-9]+)/", 1).cast("bigint")
    return rows.select(block.alias("block"), "record_ref", F.explode("issues").alias("i")).select(
        "block", "record_ref", "i.raw"
    )


# ------------------------------------------------------------- scalar functions


def order_text(t: Tables) -> DataFrame:
    """Order dates and prices written in several forms."""
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    iso = day.cast("string")
    form = key % 10
    date_text = (
        F.when(form == 1, F.date_format(day, "yyyy-M-dd"))
        .when(form == 2, F.concat(iso, F.lit("T00:00:00")))
        .when(form == 3, F.concat(iso, F.lit("T10:00:00")))
        .when(form == 4, F.concat(F.lit(" ﻿"), iso, F.lit(" 00:00:00.000 ")))
        .when(form == 5, F.concat(F.substring(iso, 1, 5), F.lit("02-30")))
        .when(form == 6, F.substring(iso, 1, 4))
        .otherwise(iso)
    )
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    number_text = (
        F.when(form == 1, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(form == 2, F.concat(price, F.lit("x")))
        .when(form == 3, "NaN")
        .when(form == 4, "")
        .when(form == 5, F.concat(key.cast("string"), F.lit(".0")))
        .when(form == 6, key.cast("string"))
        .when(form == 7, "0.0")
        .when(form == 8, "Infinity")
        .otherwise(price)
    )
    return t.table("orders").select(
        key.alias("id"), date_text.alias("date_text"), number_text.alias("number_text")
    )


@query(
    "p2_trade_dates",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 IN (3, 5, 6) OR (o_orderkey % 10 = 1 AND month(o_orderdate) < 10)
    THEN NULL ELSE CAST(o_orderdate AS DATE) END AS trade_date FROM orders""",
)
def _(t: Tables) -> DataFrame:
    date = normalize.trade_date(F.col("date_text"))
    return order_text(t).select("id", date.alias("trade_date"))


_NUMBER = """CASE o_orderkey % 10 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 8 THEN NULL
    WHEN 5 THEN CAST(o_orderkey AS DOUBLE) WHEN 6 THEN CAST(o_orderkey AS DOUBLE) WHEN 7 THEN 0.0
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END"""


@query("p3_decimals", f"SELECT o_orderkey AS id, CAST({_NUMBER} AS DOUBLE) AS value FROM orders")
def _(t: Tables) -> DataFrame:
    return order_text(t).select("id", normalize.number(F.col("number_text")).alias("value"))


@query(
    "p4_integers",
    f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 30 IN (1, 11) THEN NULL WHEN o_orderkey % 30 = 21 THEN 125
      WHEN v = floor(v) THEN CAST(v AS BIGINT) END AS value FROM (SELECT o_orderkey, {_NUMBER} AS v FROM orders) x""",
)
def _(t: Tables) -> DataFrame:
    part = F.col("id") % 30
    exact = F.when(part == 1, "1e-11").when(part == 11, "5.00000000001e0").when(part == 21, " 12.50E1")
    text = F.when(part.isin(1, 11, 21), exact).otherwise(F.col("number_text"))
    return order_text(t).select("id", normalize.integer(text).alias("value"))


@query(
    "p5_zero_to_null",
    f"""SELECT o_orderkey AS id, CAST(nullif(v, 0) AS DOUBLE) AS value FROM (SELECT o_orderkey, {_NUMBER} AS v FROM orders) x""",
)
def _(t: Tables) -> DataFrame:
    value = normalize.positive_or_null(normalize.number(F.col("number_text")))
    return order_text(t).select("id", value.alias("value"))


@query(
    "p1_security_id_text",
    """SELECT DISTINCT p_type, CASE WHEN regexp_full_match(p_type, '[A-Z0-9]+') THEN 'dev:bench:' || p_type END AS security_id,
    CASE WHEN regexp_full_match(p_type, '[A-Z0-9]+') THEN p_type END AS back, p_name FROM part""",
)
def _(t: Tables) -> DataFrame:
    identity = STOCK.security_id_text(F.col("p_type"))
    return (
        t.table("part")
        .select("p_type", identity.alias("security_id"), "p_name")
        .distinct()
        .withColumn("back", STOCK.source_key(F.col("security_id")))
    )


@query(
    "p6_trading_status",
    """SELECT l_linestatus, CASE WHEN v > 0 THEN 'traded' WHEN v = 0 AND h = 0 THEN 'no_regular_market_trade' ELSE 'unknown' END AS status, count(*) AS n
    FROM (SELECT l_linestatus, l_quantity - 10 AS v, CASE WHEN l_discount > 0.05 THEN 0 ELSE 1 END AS h FROM lineitem) x GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    volume = F.col("l_quantity") - 10
    edge = F.when(F.col("l_discount") > 0.05, 0).otherwise(1)
    status = normalize.trading_status(volume, edge, edge)
    return (
        t.table("lineitem")
        .groupBy("l_linestatus", status.alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "p7_row_flags",
    """SELECT flags, count(*) AS n FROM (SELECT concat_ws('|', CASE WHEN l_quantity > 25 THEN 'non_regular_activity_present' END,
    CASE WHEN isodow(CAST(l_shipdate AS DATE)) >= 6 THEN 'unverified_trading_date' END) AS flags FROM lineitem) x GROUP BY flags""",
)
def _(t: Tables) -> DataFrame:
    flags = normalize.row_flags(F.col("l_quantity") - 25, F.to_date("l_shipdate"))
    joined = F.array_join(flags, "|").alias("flags")
    return t.table("lineitem").groupBy(joined).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p11_normalize_ticker",
    """SELECT s_suppkey, CASE WHEN regexp_full_match(upper(trim(s_name)), '[A-Z0-9]+') THEN upper(trim(s_name)) END AS name,
    'SUPP' || s_suppkey AS code FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    code = F.concat(F.lit("\t supp"), F.col("s_suppkey").cast("string"), F.lit(" "))
    return t.table("supplier").select(
        "s_suppkey",
        normalize.normalize_ticker(F.col("s_name")).alias("name"),
        normalize.normalize_ticker(code).alias("code"),
    )


@query(
    "s21_json_field_scan",
    """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    k = normalize.integer(F.get_json_object("props", "$.k"))
    return t.table("events").groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))
