"""Ordered scans, event and dividend matching, factors, series, calendar."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.bindings import sql as _sql  # noqa: F401  (defines the shared SQL pieces)
from tickerloom.bindings.derived import SOURCE, Tables
from tickerloom.bindings.registry import query
from tickerloom.operators.compare import compare_tables, symmetric_difference
from tickerloom.operators.ordered import asof_forward
from tickerloom.operators.sizes import in_tasks
from tickerloom.plans import calendar, factors, series
from tickerloom.plans.durable import durable
from tickerloom.schemas import FACTOR_COMPARED, FACTOR_KEY, FactorMethod

# About 21 securities trade per date in these tables, so the market-wide share
# is raised from 0.05: there, two mismatches already make an anomaly date.
METHOD = FactorMethod(market_wide_share=Decimal("0.20"))


def breaks(t: Tables) -> DataFrame:
    return factors.discontinuities(t.bars)


def anomalies(t: Tables, found: DataFrame) -> DataFrame:
    return factors.anomaly_dates(factors.date_statistics(t.bars, found), METHOD)


def build(t: Tables) -> factors.FactorBuild:
    return factors.derive_factors(
        t.bars,
        t.events,
        t.dividends,
        price_source_id=SOURCE,
        event_source_id=SOURCE,
        dividend_source_id=SOURCE,
        method=METHOD,
    )


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


@query(
    "s21_stored_price_scan",
    """SELECT security_id, trading_date, CAST(close AS DOUBLE) AS close,
    CAST(reference_price AS DOUBLE) AS reference_price FROM bars WHERE source_id = 'bench'""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return t.bars.filter(F.col("source_id") == SOURCE).select(
        "security_id", "trading_date", "close", "reference_price"
    )


@query(
    "w1_previous_rows",
    """SELECT security_id, trading_date, prev_trading_date, CAST(prev_close AS DOUBLE) AS prev_close,
    CAST(prev_file_id AS BIGINT) AS prev_file_id, CAST(prev_source_line AS BIGINT) AS prev_source_line,
    CAST(prev2_close AS DOUBLE) AS prev2_close FROM prev_rows""",
    "prev_rows",
)
def _(t: Tables) -> DataFrame:
    return factors.with_previous_rows(t.bars).drop(
        "close", "reference_price", "file_id", "source_line"
    )


@query(
    "w2_discontinuities",
    """SELECT security_id, trading_date, CAST(reference_price AS DOUBLE) AS reference_price,
    CAST(prev_close AS DOUBLE) AS prev_close FROM breaks""",
    "breaks",
)
def _(t: Tables) -> DataFrame:
    return breaks(t).select("security_id", "trading_date", "reference_price", "prev_close")


@query(
    "w3_shifted_rows",
    """SELECT security_id, trading_date, CAST(prev2_close AS DOUBLE) AS prev2_close FROM breaks
    WHERE reference_price = prev2_close""",
    "breaks",
)
def _(t: Tables) -> DataFrame:
    return (
        breaks(t)
        .filter(F.col("reference_price") == F.col("prev2_close"))
        .select("security_id", "trading_date", "prev2_close")
    )


@query(
    "p22_price_factor",
    """SELECT security_id, trading_date,
    round(CAST(reference_price AS DOUBLE) / CAST(prev_close AS DOUBLE), 9) AS factor FROM breaks""",
    "breaks",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.functions.returns import price_factor

    factor = price_factor(F.col("reference_price"), F.col("prev_close"))
    return rounded(
        breaks(t).select("security_id", "trading_date", factor.alias("factor")), 9, "factor"
    )


@query(
    "a10_date_mismatch_counts",
    """SELECT trading_date, mismatched_securities, compared_securities, shifted_row_matches
    FROM date_stats""",
    "date_stats",
)
def _(t: Tables) -> DataFrame:
    return factors.date_statistics(t.bars, durable(breaks(t)))


@query(
    "a11_anomaly_dates",
    """SELECT trading_date, mismatched_securities, compared_securities, shifted_row_matches
    FROM anomalies""",
    "anomalies",
)
def _(t: Tables) -> DataFrame:
    return anomalies(t, durable(breaks(t)))


@query(
    "j8_event_interval_match",
    "SELECT security_id, trading_date, event_id, label FROM matched",
    "matched",
)
def _(t: Tables) -> DataFrame:
    return factors.match_events(durable(breaks(t)), t.events, METHOD)


@query(
    "w6_nearest_event_choice",
    """SELECT label, count(*) AS n, CAST(min(event_id) AS BIGINT) AS lowest_event,
    CAST(max(event_id) AS BIGINT) AS highest_event FROM matched GROUP BY label""",
    "matched",
)
def _(t: Tables) -> DataFrame:
    matched = factors.match_events(durable(breaks(t)), t.events, METHOD)
    return matched.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("lowest_event"),
        F.max("event_id").alias("highest_event"),
    )


@query(
    "j11_anomaly_exclusion",
    "SELECT security_id, trading_date, classification, status FROM price_factors",
    "price_factors",
)
def _(t: Tables) -> DataFrame:
    found = durable(breaks(t))
    return factors.price_factors(found, anomalies(t, found), t.events, METHOD).select(
        "security_id",
        F.col("effective_date").alias("trading_date"),
        "classification",
        "status",
    )


@query(
    "a12_dividends_by_ex_date",
    "SELECT security_id, ex_date, CAST(amount AS DOUBLE) AS amount FROM div_by_ex",
    "div_by_ex",
)
def _(t: Tables) -> DataFrame:
    return factors.dividends_by_ex_date(t.dividends)


@query(
    "j9_dividend_asof",
    """SELECT security_id, ex_date, effective_date, CAST(close AS DOUBLE) AS close,
    CAST(reference_price AS DOUBLE) AS reference_price FROM placed""",
    "placed",
)
def _(t: Tables) -> DataFrame:
    placed = factors.place_dividends(t.bars, t.dividends)
    return placed.select(
        "security_id",
        "ex_date",
        F.col("hit.date").alias("effective_date"),
        "hit.close",
        "hit.reference_price",
    )


@query(
    "t1_first_traded_row",
    """SELECT d.security_id, d.ex_date, min(p.trading_date) AS first_traded
    FROM div_by_ex d LEFT JOIN bars p ON p.security_id = d.security_id
      AND p.trading_date >= d.ex_date AND p.trading_status = 'traded'
    GROUP BY d.security_id, d.ex_date""",
    "div_by_ex",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return asof_forward(
        factors.dividends_by_ex_date(t.dividends),
        t.bars.filter(F.col("trading_status") == "traded"),
        ["security_id"],
        "ex_date",
        "trading_date",
        [],
    ).select("security_id", "ex_date", F.col("hit.date").alias("first_traded"))


@query(
    "j10_listed_by_ex_date",
    """SELECT d.security_id, d.ex_date, EXISTS (SELECT 1 FROM bars q
      WHERE q.security_id = d.security_id AND q.trading_date <= d.ex_date) AS listed
    FROM div_by_ex d""",
    "div_by_ex",
    "bars",
)
def _(t: Tables) -> DataFrame:
    placed = factors.place_dividends(t.bars, t.dividends)
    return placed.select(
        "security_id",
        "ex_date",
        (F.col("outcome") != "skipped_before_first_row").alias("listed"),
    )


@query(
    "p23_dividend_factor",
    """SELECT security_id, effective_date,
    round(CAST(close AS DOUBLE) / (CAST(close AS DOUBLE) + CAST(amount AS DOUBLE)), 9) AS factor
    FROM merged_div""",
    "merged_div",
)
def _(t: Tables) -> DataFrame:
    merged = factors.merge_dividends(factors.place_dividends(t.bars, t.dividends))
    return rounded(
        factors.dividend_factors(merged).select("security_id", "effective_date", "factor"),
        9,
        "factor",
    )


@query(
    "a13_merged_dividends",
    """SELECT security_id, effective_date, CAST(amount AS DOUBLE) AS amount, source_ex_date, records
    FROM merged_div""",
    "merged_div",
)
def _(t: Tables) -> DataFrame:
    merged = factors.merge_dividends(factors.place_dividends(t.bars, t.dividends))
    return merged.select("security_id", "effective_date", "amount", "source_ex_date", "records")


@query(
    "a13_dividend_counters",
    """SELECT * FROM (
      SELECT 'dividend.' || outcome AS name, count(*) AS n FROM placed WHERE outcome <> 'applied' GROUP BY outcome
      UNION ALL SELECT 'dividend.applied', count(*) FROM merged_div
      UNION ALL SELECT 'dividend.records_applied', CAST(sum(records) AS BIGINT) FROM merged_div
      UNION ALL SELECT 'dividend.postponed_to_next_traded_day', count(*) FROM merged_div WHERE effective_date <> source_ex_date
      UNION ALL SELECT 'dividend.merged_same_effective_date', count(*) FROM merged_div WHERE records > 1) c
    WHERE n > 0""",
    "placed",
    "merged_div",
)
def _(t: Tables) -> DataFrame:
    placed = durable(factors.place_dividends(t.bars, t.dividends))
    return factors.dividend_counts(placed, factors.merge_dividends(placed))


@query(
    "c1_derive_factors",
    """SELECT security_id, effective_date, factor_kind, round(factor, 9) AS factor, classification,
    status, CAST(reference_price AS DOUBLE) AS reference_price, CAST(close AS DOUBLE) AS close,
    prev_trading_date, CAST(prev_close AS DOUBLE) AS prev_close,
    CAST(dividend_amount AS DOUBLE) AS dividend_amount, source_ex_date,
    CAST(event_id AS BIGINT) AS corporate_action_event_id, CAST(file_id AS BIGINT) AS file_id,
    CAST(source_line AS BIGINT) AS source_line, CAST(prev_file_id AS BIGINT) AS prev_file_id,
    CAST(prev_source_line AS BIGINT) AS prev_source_line,
    'bench' AS price_source_id, 'ref-v1' AS method_version FROM all_factors""",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    return rounded(build(t).factors, 9, "factor")


@query(
    "p25_factor_row_shape",
    """SELECT factor_kind, count(*) AS n, count(prev_close) AS with_prev_close,
    count(dividend_amount) AS with_amount, count(source_ex_date) AS with_ex_date,
    count(event_id) AS with_event FROM all_factors GROUP BY factor_kind""",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    return (
        build(t)
        .factors.groupBy("factor_kind")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("prev_close").alias("with_prev_close"),
            F.count("dividend_amount").alias("with_amount"),
            F.count("source_ex_date").alias("with_ex_date"),
            F.count("corporate_action_event_id").alias("with_event"),
        )
    )


@query(
    "a14_build_summary",
    """SELECT 'price.' || classification || '.' || status AS name, count(*) AS n
    FROM price_factors GROUP BY classification, status
    UNION ALL SELECT 'securities_with_factors', count(DISTINCT security_id) FROM all_factors
    UNION ALL SELECT 'factor_rows', count(*) FROM all_factors
    UNION ALL SELECT 'anomaly_dates', count(*) FROM anomalies""",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    b = build(t)
    rows = b.factors.agg(
        F.count_distinct("security_id").alias("securities_with_factors"),
        F.count(F.lit(1)).alias("factor_rows"),
    ).selectExpr(
        "stack(2, 'securities_with_factors', securities_with_factors, 'factor_rows', factor_rows)"
        " AS (name, n)"
    )
    dates = b.anomalies.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("anomaly_dates").alias("name"), "n"
    )
    return factors.factor_counts(b.factors).unionByName(rows).unionByName(dates)


_ROUND = "CAST(round(CAST(factor AS DOUBLE) * 1e9) AS BIGINT)"
#: Every factor column in both engines' SQL; the factor to nine places, amounts to four.
_DIGESTED = (
    *((c, c) for c in ("security_id", "effective_date", "factor_kind", "classification", "status")),
    (_ROUND, _ROUND),
    *(
        (f"CAST({c} AS DECIMAL(30,4))",) * 2
        for c in ("reference_price", "close", "prev_close", "dividend_amount")
    ),
    *((c, c) for c in ("prev_trading_date", "source_ex_date")),
    ("event_id", "corporate_action_event_id"),
    *((c, c) for c in ("file_id", "source_line", "prev_file_id", "prev_source_line")),
    ("'bench'", "price_source_id"),
    ("'ref-v1'", "method_version"),
)


@query(
    "a15_factor_digest",
    """SELECT CAST(max(n) AS BIGINT) AS rows,
      sha256(CAST(max(n) AS VARCHAR) || ':' || string_agg(s, ':' ORDER BY i)) AS digest
    FROM (SELECT i, count(*) AS n, CAST(sum(CAST('0x' || substr(h, 1 + 16 * i, 15) AS BIGINT)) AS VARCHAR) AS s
      FROM (SELECT sha256(concat_ws(chr(31), """
    + ", ".join(f"coalesce(CAST({sql} AS VARCHAR), '␀')" for sql, _ in _DIGESTED)
    + """)) AS h FROM all_factors) f, (SELECT unnest([0, 1, 2, 3]) AS i) k GROUP BY i) g""",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.functions.digest import multiset_digest

    return multiset_digest(build(t).factors, [F.expr(spark) for _, spark in _DIGESTED])


@query(
    "j12_factor_compare",
    """SELECT count(*) FILTER (WHERE d.k % 13 = 0) AS missing,
    count(*) FILTER (WHERE d.k % 13 <> 0 AND d.k % 17 = 0) AS observation_differs,
    CAST(0 AS BIGINT) AS provenance_differs, count(*) FILTER (WHERE d.k % 13 <> 0 AND d.k % 19 = 0) AS extra
    FROM (SELECT date_diff('day', DATE '1970-01-01', effective_date) + security_id AS k FROM all_factors) d""",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    fresh = build(t).factors
    k = F.unix_date("effective_date") + F.col("security_id")
    stored = fresh.filter(k % 13 != 0).withColumn(
        "factor", F.when(k % 17 == 0, (F.col("factor") * 2).cast("decimal(38,18)")).otherwise(F.col("factor"))
    )
    later = stored.filter(k % 19 == 0).withColumn("effective_date", F.date_add("effective_date", 20000))
    return compare_tables(fresh, stored.unionByName(later), FACTOR_KEY, FACTOR_COMPARED)


@query(
    "u2_anomaly_symmetric_difference",
    """SELECT trading_date, 'left' AS only_in FROM anomalies
      WHERE trading_date NOT IN (SELECT trading_date FROM date_stats WHERE shifted_row_matches > 0)
    UNION ALL SELECT trading_date, 'right' FROM date_stats WHERE shifted_row_matches > 0
      AND trading_date NOT IN (SELECT trading_date FROM anomalies)""",
    "anomalies",
)
def _(t: Tables) -> DataFrame:
    stats = durable(factors.date_statistics(t.bars, durable(breaks(t))))
    fresh = factors.anomaly_dates(stats, METHOD).select("trading_date")
    return symmetric_difference(
        fresh, stats.filter("shifted_row_matches > 0").select("trading_date")
    )


_SERIES = """SELECT security_id, trading_date, CAST(close AS DOUBLE) AS close,
    CAST(reference_price AS DOUBLE) AS reference_price, round(price_return, 6) AS price_return,
    round(total_return, 6) AS total_return, CAST(dividend AS DOUBLE) AS dividend,
    round(adj_close, 3) AS adj_close, round(tr_adj_close, 3) AS tr_adj_close, reliable FROM series"""


@query("c3_adjusted_series", _SERIES, "series")
def _(t: Tables) -> DataFrame:
    b = build(t)
    bars = series.adjusted_bars(t.bars, b.factors, b.anomalies, SOURCE, METHOD.version)
    return rounded(
        rounded(bars, 6, "price_return", "total_return"), 3, "adj_close", "tr_adj_close"
    )


@query(
    "w4_adjusted_close",
    "SELECT security_id, trading_date, round(adj_close, 3) AS adj_close FROM series",
    "series",
)
def _(t: Tables) -> DataFrame:
    b = build(t)
    bars = series.adjusted_bars(t.bars, b.factors, b.anomalies, SOURCE, METHOD.version)
    return rounded(bars.select("security_id", "trading_date", "adj_close"), 3, "adj_close")


@query(
    "p20_price_return",
    """SELECT security_id, trading_date, round(CAST(close AS DOUBLE) / CAST(reference_price AS DOUBLE) - 1, 6) AS price_return
    FROM bars""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.functions.returns import price_return

    value = price_return(F.col("close"), F.col("reference_price"))
    return rounded(
        t.bars.select("security_id", "trading_date", value.alias("price_return")), 6, "price_return"
    )


@query(
    "p21_total_return",
    """SELECT security_id, trading_date, round(total_return, 6) AS total_return,
    CAST(dividend AS DOUBLE) AS dividend FROM series""",
    "series",
)
def _(t: Tables) -> DataFrame:
    b = build(t)
    bars = series.adjusted_bars(t.bars, b.factors, b.anomalies, SOURCE, METHOD.version)
    return rounded(
        bars.select("security_id", "trading_date", "total_return", "dividend"), 6, "total_return"
    )


@query(
    "w8_reliable_bars",
    """SELECT reliable, count(*) AS n, count(DISTINCT trading_date) AS dates FROM series GROUP BY reliable""",
    "series",
)
def _(t: Tables) -> DataFrame:
    found = durable(breaks(t))
    by_date = t.bars.groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"))
    return (
        series.marked_reliable(by_date, anomalies(t, found))
        .groupBy("reliable")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("dates"))
    )


@query(
    "j19_bars_with_factors",
    """SELECT b.security_id, b.trading_date, round(p.factor, 9) AS price_factor,
    CAST(d.dividend_amount AS DOUBLE) AS dividend_amount, a.trading_date IS NOT NULL AS on_anomaly_date
    FROM bars b
    LEFT JOIN all_factors p ON p.security_id = b.security_id AND p.effective_date = b.trading_date
      AND p.factor_kind = 'price' AND p.status = 'applied'
    LEFT JOIN all_factors d ON d.security_id = b.security_id AND d.effective_date = b.trading_date
      AND d.factor_kind = 'cash_dividend' AND d.status = 'applied'
    LEFT JOIN anomalies a ON a.trading_date = b.trading_date""",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    b = build(t)
    steps = series.applied_steps(b.factors)
    applied = b.factors.filter("status = 'applied' AND factor_kind = 'price'").select(
        "security_id", F.col("effective_date").alias("trading_date"), "factor"
    )
    flagged = b.anomalies.select("trading_date", F.lit(True).alias("a"))
    return rounded(
        in_tasks(t.bars.select("security_id", "trading_date"), "security_id", "trading_date")
        .join(steps, ["security_id", "trading_date"], "left")
        .join(applied, ["security_id", "trading_date"], "left")
        .join(F.broadcast(flagged), "trading_date", "left")
        .select(
            "security_id",
            "trading_date",
            F.col("factor").alias("price_factor"),
            "dividend_amount",
            F.col("a").isNotNull().alias("on_anomaly_date"),
        ),
        9,
        "price_factor",
    )


_INDEX = """SELECT index_code, trading_date, CAST(close AS DOUBLE) AS close, CAST(previous AS DOUBLE) AS previous,
    round(CAST(close AS DOUBLE) / CAST(previous AS DOUBLE) - 1, 6) AS index_return,
    (prior IS NULL OR previous = prior) AND NOT f_weekend AS reliable
  FROM (SELECT *, lag(close) OVER (PARTITION BY index_code ORDER BY trading_date) AS prior FROM index_values) x"""


@query("w5_index_continuity", _INDEX, "index_values")
def _(t: Tables) -> DataFrame:
    return rounded(series.index_bars(t.index_values).drop("source_id"), 6, "index_return")


@query(
    "c4_index_series",
    """SELECT index_code, count(*) AS bars, count(*) FILTER (WHERE reliable) AS reliable_bars,
    round(sum(index_return), 4) AS summed_return, min(trading_date) AS first_date, max(trading_date) AS last_date
    FROM ("""
    + _INDEX
    + ") s GROUP BY index_code",
    "index_values",
)
def _(t: Tables) -> DataFrame:
    bars = rounded(series.index_bars(t.index_values), 6, "index_return")
    return rounded(
        bars.groupBy("index_code").agg(
            F.count(F.lit(1)).alias("bars"),
            F.count_if("reliable").alias("reliable_bars"),
            F.sum("index_return").alias("summed_return"),
            F.min("trading_date").alias("first_date"),
            F.max("trading_date").alias("last_date"),
        ),
        4,
        "summed_return",
    )


@query(
    "p24_index_return",
    """SELECT index_code, trading_date, round(CAST(close AS DOUBLE) / CAST(previous AS DOUBLE) - 1, 6) AS index_return
    FROM index_values""",
    "index_values",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.functions.returns import index_return

    value = index_return(F.col("close"), F.col("previous"))
    return rounded(
        t.index_values.select("index_code", "trading_date", value.alias("index_return")),
        6,
        "index_return",
    )


def order_days(t: Tables) -> DataFrame:
    return t.table("orders").select(
        F.lit(SOURCE).alias("source_id"), F.to_date("o_orderdate").alias("trading_date")
    )


@query(
    "c5_observed_trading_days",
    """SELECT 'bench' AS source_id, d.trading_date, coalesce(s.n, 0) AS stock_rows, coalesce(i.n, 0) AS index_rows,
    coalesce(s.n, 0) > 0 AS in_stock_data, coalesce(i.n, 0) > 0 AS in_index_data,
    isodow(d.trading_date) >= 6 AS is_weekend
    FROM (SELECT trading_date FROM bars UNION SELECT CAST(o_orderdate AS DATE) FROM orders) d
    LEFT JOIN (SELECT trading_date, count(*) AS n FROM bars GROUP BY 1) s USING (trading_date)
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS trading_date, count(*) AS n FROM orders GROUP BY 1) i USING (trading_date)""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return calendar.observed_trading_days(t.bars, order_days(t))


@query(
    "u1_trading_dates",
    "SELECT trading_date FROM bars UNION SELECT CAST(o_orderdate AS DATE) FROM orders",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return calendar.observed_trading_days(t.bars, order_days(t)).select("trading_date")


@query(
    "j18_index_only_dates",
    """SELECT CAST(o_orderdate AS DATE) AS trading_date, count(*) AS index_rows FROM orders
    WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT trading_date FROM bars) GROUP BY 1""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    days = calendar.observed_trading_days(t.bars, order_days(t))
    return days.filter(~F.col("in_stock_data")).select("trading_date", "index_rows")


@query(
    "a21_rows_per_date",
    "SELECT source_id, trading_date, count(*) AS stock_rows FROM bars GROUP BY source_id, trading_date",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return t.bars.groupBy("source_id", "trading_date").agg(F.count(F.lit(1)).alias("stock_rows"))


@query(
    "p26_weekend_test",
    """SELECT trading_date, isodow(trading_date) >= 6 AS is_weekend FROM (SELECT DISTINCT trading_date FROM bars) d""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return (
        t.bars.select("trading_date")
        .distinct()
        .withColumn("is_weekend", calendar.is_weekend("trading_date"))
    )


