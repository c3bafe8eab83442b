"""Row validation, table constraints, integrity rules, quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.bindings import derived
from tickerloom.bindings.derived import SOURCE, Tables
from tickerloom.bindings.registry import query
from tickerloom.bindings.series_queries import breaks, build
from tickerloom.functions import validate
from tickerloom.functions.normalize import merge_flag
from tickerloom.operators import dedupe, quality
from tickerloom.plans import factors, verify
from tickerloom.plans.durable import durable
from tickerloom.plans.load_prices import newest_dates, quarantine
from tickerloom.schemas import ROW_FLAGS, TRADING_STATUSES


def dirty(t: Tables) -> DataFrame:
    return derived.with_errors(t.numbered_bars)


def counted(*rules: tuple[str, str], source: str) -> str:
    """Check SQL counting, per rule, the rows that break it."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce(({test}), FALSE)) AS violations FROM {source}"
        for name, test in rules
    )


def violating(*rules: tuple[str, str], source: str) -> str:
    """Check SQL counting, per rule, the rows for which the test is true."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS violations FROM {source}"
        for name, test in rules
    )


# ------------------------------------------------------------------ row rules


@query(
    "v1_row_issues",
    """SELECT security_id, trading_date, concat_ws('|', nullif(hard, ''), nullif(expected, '')) AS codes
    FROM issues WHERE hard <> '' OR expected <> ''""",
    "issues",
)
def _(t: Tables) -> DataFrame:
    issues = dirty(t).withColumn("i", validate.price_issues()).filter(F.size("i") > 0)
    return issues.select("security_id", "trading_date", F.col("i.code").alias("codes"))


@query(
    "v2_hard_invalid_rows",
    "SELECT security_id, trading_date, hard AS codes FROM issues WHERE hard <> ''",
    "issues",
)
def _(t: Tables) -> DataFrame:
    issues = dirty(t).withColumn("i", validate.price_issues())
    bad = issues.filter(validate.is_hard_invalid(F.col("i")))
    return bad.select("security_id", "trading_date", validate.hard_codes(F.col("i")).alias("codes"))


@query(
    "v3_quarantine_split",
    """SELECT security_id, count(*) FILTER (WHERE hard = '') AS kept, count(*) FILTER (WHERE hard <> '') AS quarantined
    FROM issues GROUP BY security_id""",
    "issues",
)
def _(t: Tables) -> DataFrame:
    judged = quarantine(dirty(t).withColumn("reasons", F.array().cast("array<string>")))
    return judged.groupBy("security_id").agg(
        F.count_if(F.size("reasons") == 0).alias("kept"),
        F.count_if(F.size("reasons") > 0).alias("quarantined"),
    )


@query(
    "v5_range_read",
    """SELECT security_id, trading_date, CAST(close AS DOUBLE) AS close, trading_status FROM bars
    WHERE trading_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.sources.provider import read_range

    return read_range(t.bars, "1996-01-01", "1998-12-31").select(
        "security_id", "trading_date", "close", "trading_status"
    )


_STATUS = f"trading_status IN ({', '.join(repr(s) for s in TRADING_STATUSES)})"
_KNOWN_FLAGS = f"len(list_filter(fl, lambda x: x IN ({', '.join(repr(f) for f in ROW_FLAGS)})))"
# greatest and least leave NULL out, as the rules do with what was not supplied


@query(
    "v7_price_rules",
    counted(
        *((f"{c}_positive", f"coalesce({c}, 1) > 0") for c in ("open", "high", "low", "reference_price")),
        ("close_positive", "close > 0"),
        *((f"{c}_non_negative", f"coalesce({c}, 0) >= 0") for c in ("volume", "value", "frequency")),
        ("source_line_positive", "source_line > 0"),
        ("trading_status_vocabulary", _STATUS),
        (
            "traded_shape",
            """CASE WHEN trading_status = 'traded' THEN coalesce(volume, 0) > 0 AND coalesce(
              greatest(low, close, open) <= high AND least(high, close, open) >= low, FALSE) ELSE TRUE END""",
        ),
        (
            "no_regular_trade_shape",
            """CASE trading_status WHEN 'no_regular_market_trade'
              THEN coalesce(volume, -1) = 0 AND coalesce(open, high, low) IS NULL ELSE TRUE END""",
        ),
        ("quality_flags_vocabulary", f"{_KNOWN_FLAGS} = len(fl)"),
        source="dirty",
    ),
    "dirty",
)
def _(t: Tables) -> DataFrame:
    return validate.count_broken(dirty(t), validate.price_rules())


_MATCH = (
    ("security_match_vocabulary", "m IN ('ticker_text_match', 'unmatched')"),
    ("security_match_consistent", "(m = 'unmatched') = (s IS NULL)"),
)


@query(
    "v8_event_rules",
    counted(
        *_MATCH,
        ("shares_involved_non_negative", "a >= 0"),
        ("shares_after_non_negative", "b IS NULL OR b >= 0"),
        source="ev",
    ).join(
        (
            "WITH ev AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'unmatched' WHEN o_orderkey % 50 = 0 THEN 'guess' ELSE 'ticker_text_match' END AS m, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS s, o_totalprice - 100000 AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice - 200000 END AS b FROM orders)\n",
            "",
        )
    ),
)
def _(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    rows = t.table("orders").select(
        F.when(key % 3 == 0, "unmatched")
        .when(key % 50 == 0, "guess")
        .otherwise("ticker_text_match")
        .alias("security_match"),
        F.when(key % 4 != 0, F.col("o_custkey")).alias("security_id"),
        (F.col("o_totalprice") - 100000).alias("shares_involved"),
        F.when(key % 5 != 0, F.col("o_totalprice") - 200000).alias("shares_after"),
    )
    return validate.count_broken(rows, validate.event_rules())


@query(
    "v8_dividend_rules",
    counted(
        *_MATCH,
        ("amount_positive", "a > 0"),
        ("amount_basis_vocabulary", "b IN ('gross', 'net', 'unstated')"),
        source="dv",
    ).join(
        (
            "WITH dv AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'unmatched' ELSE 'ticker_text_match' END AS m, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS s, o_totalprice - 100000 AS a, lower(o_orderstatus) AS st, CASE o_orderstatus WHEN 'O' THEN 'gross' WHEN 'F' THEN 'unstated' ELSE 'other' END AS b FROM orders)\n",
            "",
        )
    ),
)
def _(t: Tables) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = t.table("orders").select(
        F.when(key % 3 == 0, "unmatched").otherwise("ticker_text_match").alias("security_match"),
        F.when(key % 4 != 0, F.col("o_custkey")).alias("security_id"),
        (F.col("o_totalprice") - 100000).alias("amount"),
        F.when(status == "O", "gross")
        .when(status == "F", "unstated")
        .otherwise("other")
        .alias("amount_basis"),
    )
    return validate.count_broken(rows, validate.dividend_rules())


@query(
    "v9_factor_rules",
    counted(
        ("factor_kind_vocabulary", "factor_kind IN ('price', 'cash_dividend')"),
        (
            "classification_vocabulary",
            "classification IN ('split', 'reverse_split', 'rights', 'bonus', 'stock_dividend', 'unclassified', 'cash_dividend')",
        ),
        ("status_vocabulary", "status IN ('applied', 'excluded_market_wide_anomaly')"),
        ("factor_positive", "factor > 0"),
        ("classification_matches_kind", "(factor_kind = 'cash_dividend') = (classification = 'cash_dividend')"),
        ("dividend_amount_iff_dividend", "(factor_kind = 'cash_dividend') = (dividend_amount IS NOT NULL)"),
        (
            "price_factor_has_previous_row",
            "factor_kind <> 'price' OR (prev_close IS NOT NULL AND prev_trading_date IS NOT NULL)",
        ),
        ("source_line_positive", "source_line >= 1"),
        source="(SELECT * REPLACE (CASE WHEN security_id % 7 = 0 THEN 'price' ELSE factor_kind END AS factor_kind, CASE WHEN security_id % 5 = 0 THEN -factor ELSE factor END AS factor) FROM all_factors) x",
    ),
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    sid = F.col("security_id")
    rows = build(t).factors.withColumns(
        {
            "factor_kind": F.when(sid % 7 == 0, "price").otherwise(F.col("factor_kind")),
            "factor": F.when(sid % 5 == 0, -F.col("factor")).otherwise(F.col("factor")),
        }
    )
    return validate.count_broken(rows, validate.factor_rules())


@query(
    "v10_anomaly_rules",
    counted(
        (
            "counts_consistent",
            "mismatched_securities - 1 >= 0 AND compared_securities >= mismatched_securities - 1",
        ),
        source="date_stats",
    ),
    "date_stats",
)
def _(t: Tables) -> DataFrame:
    stats = factors.date_statistics(t.bars, durable(breaks(t)))
    lowered = stats.withColumn("mismatched_securities", F.col("mismatched_securities") - 1)
    return validate.count_broken(lowered, validate.anomaly_rules())


@query(
    "v11_index_rules",
    counted(
        ("index_code_format", "regexp_full_match(code, '[A-Za-z0-9-]+')"),
        ("values_positive", "previous > 0 AND high > 0 AND low > 0 AND close > 0"),
        ("high_low_close_shape", "high >= low AND close >= low AND close <= high"),
        ("counts_non_negative", "volume IS NULL OR volume >= 0"),
        ("quality_flags_vocabulary", "rn % 31 <> 0"),
        ("source_line_positive", "line >= 1"),
        source="(SELECT * REPLACE (CASE WHEN rn % 17 = 0 THEN high + 1 ELSE low END AS low, CASE WHEN rn % 19 = 0 THEN -close ELSE close END AS close), index_code || CASE WHEN rn % 23 = 0 THEN ' x' ELSE '' END AS code, CASE WHEN rn % 29 = 0 THEN -1 ELSE NULL END AS volume, rn - 2 AS line FROM index_values) x",
    ),
    "index_values",
)
def _(t: Tables) -> DataFrame:
    rn = F.col("source_line") - 1
    rows = t.index_values.withColumns(
        {
            "index_code": F.when(rn % 23 == 0, F.concat("index_code", F.lit(" x"))).otherwise(
                F.col("index_code")
            ),
            "low": F.when(rn % 17 == 0, F.col("high") + 1).otherwise(F.col("low")),
            "close": F.when(rn % 19 == 0, -F.col("close")).otherwise(F.col("close")),
            "volume": F.when(rn % 29 == 0, F.lit(-1)),
            "source_line": rn - 2,
            "quality_flags": F.when(rn % 31 == 0, F.array_append("quality_flags", F.lit("made_up"))).otherwise(
                F.col("quality_flags")
            ),
        }
    )
    return validate.count_broken(rows, validate.index_rules())


@query(
    "v12_snapshot_rules",
    counted(
        ("content_sha256_format", "regexp_full_match(content_sha256, '[0-9a-f]{64}')"),
        (
            "archive_sha256_format",
            "archive_sha256 IS NULL OR regexp_full_match(archive_sha256, '[0-9a-f]{64}')",
        ),
        (
            "snapshot_id_derived",
            "snapshot_id = source_id || ':' || source_revision || ':' || substr(content_sha256, 1, 16)",
        ),
        ("file_count_non_negative", "file_count >= 0"),
        ("source_id_format", "regexp_full_match(source_id, '[a-z0-9][a-z0-9-]*')"),
        source="snapshots",
    ),
    "snapshots",
)
def _(t: Tables) -> DataFrame:
    rules = validate.snapshot_rules() | validate.source_rules()
    return validate.count_broken(derived.derive_snapshots(t.table("customer")), rules)


@query(
    "v12_run_rules",
    counted(
        ("status_vocabulary", "status IN ('running', 'succeeded', 'failed')"),
        ("completion_matches_status", "(status = 'running') = (completed IS NULL)"),
        ("completed_after_started", "completed IS NULL OR completed >= started"),
        ("row_counts_non_negative", "rows_seen >= 0 AND rows_inserted >= 0"),
        source="runs",
    ),
    "runs",
)
def _(t: Tables) -> DataFrame:
    runs = derived.derive_runs(t.table("orders"), t.table("customer"))
    return validate.count_broken(runs, validate.run_rules())


# ------------------------------------------------------------ integrity rules


@query(
    "i1_duplicate_price_key",
    """SELECT 'duplicate_price_key' AS rule, count(*) AS violations FROM (
    SELECT security_id, trading_date FROM (SELECT security_id, trading_date FROM bars
      UNION ALL SELECT security_id, trading_date FROM bars WHERE rn % 50 = 0) u
    GROUP BY 1, 2 HAVING count(*) > 1) x""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    bars = t.numbered_bars
    return verify.duplicate_price_keys(bars.unionByName(bars.filter("rn % 50 = 0")))


@query(
    "i2_to_i9_row_integrity",
    violating(
        ("ohlc_relationship", "greatest(low, close, open) > high OR least(high, close, open) < low"),
        ("non_positive_price", "least(open, high, low, close, reference_price) <= 0"),
        ("negative_volume_value_frequency", "least(volume, value, frequency) < 0"),
        ("invalid_trading_status", f"NOT {_STATUS}"),
        (
            "status_inconsistent_with_volume",
            """CASE trading_status WHEN 'traded' THEN coalesce(volume, 0) < 1 OR high + low IS NULL
              WHEN 'no_regular_market_trade' THEN coalesce(volume, 1) <> 0 ELSE FALSE END""",
        ),
        ("zero_volume_with_open_high_low", "volume = 0 AND coalesce(open, high, low) IS NOT NULL"),
        ("invalid_row_flags", f"{_KNOWN_FLAGS} < len(fl)"),
        (
            "unsorted_or_duplicate_row_flags",
            "list_filter(fl, lambda x: x IS NOT NULL) <> list_sort(list_distinct(fl))",
        ),
        source="dirty",
    ),
    "dirty",
)
def _(t: Tables) -> DataFrame:
    return verify.row_integrity(verify.price_facts(dirty(t)))


@query(
    "i10_key_flags",
    violating(
        (
            "invalid_key_flags",
            "len(list_filter(fl, lambda x: x <> 'source_ticker_column_mismatch')) > 0",
        ),
        source="keys",
    ),
    "keys",
)
def _(t: Tables) -> DataFrame:
    return verify.key_flag_integrity(derived.derive_keys(t.table("supplier")))


@query(
    "i11_to_i17_provenance",
    """SELECT 'price_from_unregistered_or_non_stock_file' AS rule, count(*) AS violations FROM dirty p
      LEFT JOIN files f USING (file_id) WHERE f.file_id IS NULL OR f.source_key IS NULL
    UNION ALL SELECT 'price_file_key_differs_from_security_key', count(*) FROM dirty p JOIN files f USING (file_id)
      JOIN keys k ON k.security_id = p.security_id WHERE k.source_key <> f.source_key
    UNION ALL SELECT 'price_without_source_key', count(*) FROM dirty p LEFT JOIN keys k ON k.security_id = p.security_id
      WHERE k.security_id IS NULL
    UNION ALL SELECT 'price_from_unsuccessful_run', count(*) FROM dirty WHERE ingestion_run_id = 'run-2'
    UNION ALL SELECT 'file_snapshot_of_other_source', count(*) FROM dirty p JOIN files f USING (file_id)
      WHERE f.snapshot_id = 'other:r1:0'""",
    "dirty",
    "files",
    "keys",
)
def _(t: Tables) -> DataFrame:
    runs = t.spark.createDataFrame(
        [("run-1", "succeeded"), ("run-2", "failed")], "ingestion_run_id string, status string"
    )
    snapshots = t.spark.createDataFrame(
        [("bench:r1:0", SOURCE), ("other:r1:0", "other")], "snapshot_id string, source_id string"
    )
    supplier = t.table("supplier")
    return verify.provenance_integrity(
        verify.price_facts(dirty(t)),
        derived.derive_files(supplier, t.bars),
        derived.derive_keys(supplier),
        runs,
        snapshots,
    )


@query(
    "i14_source_line_in_file",
    """SELECT 'source_line_outside_file' AS rule, count(*) AS violations FROM dirty p JOIN files f USING (file_id)
    WHERE p.source_line < 2 OR p.source_line > f.row_count + 1""",
    "dirty",
    "files",
)
def _(t: Tables) -> DataFrame:
    rows = dirty(t)
    files = derived.derive_files(t.table("supplier"), t.bars)
    return verify.lines_outside_files(verify.price_facts(rows), rows, files)


@query(
    "i15_duplicate_source_line",
    """SELECT 'duplicate_source_line' AS rule, count(*) AS violations FROM (
    SELECT 1 FROM dirty GROUP BY file_id, source_line HAVING count(*) > 1) x""",
    "dirty",
)
def _(t: Tables) -> DataFrame:
    return verify.duplicate_source_lines(dirty(t))


@query(
    "i18_i19_security_identity",
    """SELECT 'security_not_development_identity' AS rule, count(*) AS violations FROM securities s
      JOIN keys k USING (security_id) WHERE s.identity_kind <> 'development'
    UNION ALL SELECT 'security_ticker_differs_from_key', count(*) FROM securities s
      JOIN keys k USING (security_id) WHERE s.ticker <> k.source_key""",
    "securities",
    "keys",
)
def _(t: Tables) -> DataFrame:
    supplier = t.table("supplier")
    return verify.identity_integrity(
        derived.derive_securities(supplier), derived.derive_keys(supplier)
    )


@query(
    "i20_i21_run_integrity",
    violating(
        ("stale_running_run", "status = 'running'"),
        ("run_counter_invariant", "status = 'succeeded' AND rows_seen <> rows_inserted + collapsed"),
        source="runs",
    ),
    "runs",
)
def _(t: Tables) -> DataFrame:
    return verify.run_integrity(derived.derive_runs(t.table("orders"), t.table("customer")))


@query(
    "i22_adjustment_columns",
    """SELECT 'adjustment_columns_present' AS rule, CAST(2 AS BIGINT) AS violations, count(*) AS rows FROM bars""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    widened = t.bars.withColumns({"adj_close": F.col("close") * 2, "split_factor": F.col("close") * 3})
    return widened.agg(
        F.lit("adjustment_columns_present").alias("rule"),
        F.lit(verify.adjustment_columns(widened)).alias("violations"),
        F.count(F.lit(1)).alias("rows"),
    )


# ----------------------------------------------------------------- aggregates


_REPORT = """SELECT count(DISTINCT security_id) AS securities, count(*) AS rows,
    count(*) FILTER (WHERE open IS NULL) AS missing_open, count(*) FILTER (WHERE volume = 0) AS zero_volume,
    count(*) FILTER (WHERE regexp_matches(hard, 'high|low|range|non_positive')) AS invalid_ohlc,
    count(*) FILTER (WHERE hard LIKE '%negative_volume%') AS negative_volume,
    count(*) FILTER (WHERE hard <> '') AS hard_invalid_rows,
    CAST(count(*) - count(DISTINCT (security_id, trading_date)) AS BIGINT) AS duplicates,
    min(trading_date) AS first_date, max(trading_date) AS last_date,
    round(100.0 * count(*) FILTER (WHERE open IS NULL) / count(*), 9) AS missing_open_pct
    FROM (SELECT * FROM issues UNION ALL SELECT * FROM issues WHERE rn % 50 = 0) i"""


@query("a1_quality_report", _REPORT, "issues")
def _(t: Tables) -> DataFrame:
    rows = dirty(t)
    report = quality.quality_report(rows.unionByName(rows.filter("rn % 50 = 0")))
    return report.withColumn("missing_open_pct", F.round("missing_open_pct", 9))


@query(
    "p27_missing_open_pct",
    """SELECT security_id, round(100.0 * count(*) FILTER (WHERE open IS NULL) / count(*), 9) AS missing_open_pct
    FROM bars GROUP BY security_id""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    counts = t.bars.groupBy("security_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("open").isNull()).alias("missing_open")
    )
    return counts.select("security_id", F.round(quality.missing_open_pct(), 9).alias("missing_open_pct"))


@query(
    "a2_duplicate_groups",
    """SELECT security_id, trading_date, count(*) AS copies FROM (SELECT security_id, trading_date FROM bars
    UNION ALL SELECT security_id, trading_date FROM bars WHERE rn % 50 = 0) u GROUP BY 1, 2 HAVING count(*) > 1""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    bars = t.numbered_bars
    doubled = bars.unionByName(bars.filter("rn % 50 = 0"))
    return dedupe.duplicate_keys(doubled, ["security_id", "trading_date"])


_STATS = """count(*) AS rows, count(*) FILTER (WHERE open IS NULL) AS missing_open,
    count(*) FILTER (WHERE volume = 0) AS zero_volume, count(*) FILTER (WHERE f_nonreg AND f_weekend) AS multi_flag_rows,
    min(trading_date) AS first_date, max(trading_date) AS last_date FROM bars"""


@query("a7_observation_stats", f"SELECT {_STATS}", "bars")
def _(t: Tables) -> DataFrame:
    return quality.observation_stats(t.bars)


@query("a16_stored_aggregates", f"SELECT {_STATS} WHERE source_id = 'bench'", "bars")
def _(t: Tables) -> DataFrame:
    return quality.observation_stats(t.bars.filter(F.col("source_id") == SOURCE))


@query(
    "a17_status_counts",
    """SELECT s.trading_status, count(b.security_id) AS n
    FROM (SELECT unnest(['traded', 'no_regular_market_trade', 'unknown']) AS trading_status) s
    LEFT JOIN bars b USING (trading_status) GROUP BY s.trading_status""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return quality.status_counts(t.bars)


@query(
    "a18_flag_counts",
    "SELECT flag, count(*) AS n FROM (SELECT unnest(fl) AS flag FROM base_flags) f GROUP BY flag",
    "base_flags",
)
def _(t: Tables) -> DataFrame:
    return quality.flag_counts(t.bars)


@query(
    "a19_latest_stored_date",
    "SELECT security_id, max(trading_date) AS stored_date FROM bars GROUP BY security_id",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return newest_dates(t.bars)


@query(
    "p28_flag_merge",
    """SELECT security_id, array_to_string(list_sort(list_distinct(list_append(fl, 'source_ticker_column_mismatch'))), '|') AS flags
    FROM keys""",
    "keys",
)
def _(t: Tables) -> DataFrame:
    keys = derived.derive_keys(t.table("supplier"))
    return keys.select(
        "security_id",
        merge_flag(F.col("quality_flags"), "source_ticker_column_mismatch").alias("flags"),
    )


