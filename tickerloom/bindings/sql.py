"""Shared pieces of the check SQL (written for DuckDB, not used by Spark)."""

from tickerloom.bindings.registry import cte

cte(
    "daily",
    """SELECT security_id, trading_date, max(p) AS hi, min(p) AS lo, sum(q) AS vol,
    sum(p) AS val, count(*) AS freq
  FROM (SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS trading_date,
          CAST(l_extendedprice AS DECIMAL(20,4)) AS p, CAST(l_quantity AS BIGINT) AS q
        FROM lineitem) l
  GROUP BY security_id, trading_date""",
)
cte(
    "numbered",
    """SELECT *, CAST((hi + lo) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(20,4)) AS close,
    row_number() OVER (PARTITION BY security_id ORDER BY trading_date) AS rn,
    date_diff('day', DATE '1995-01-01', trading_date) AS dn
  FROM daily""",
    "daily",
)
cte(
    "lagged",
    """SELECT *, lag(close) OVER w AS pc, lag(close, 2) OVER w AS pc2 FROM numbered
  WINDOW w AS (PARTITION BY security_id ORDER BY trading_date)""",
    "numbered",
)
cte(
    "bars",
    """SELECT 'bench' AS source_id, security_id, trading_date, rn,
    CASE WHEN (security_id + rn) % 11 = 0 OR (security_id + rn) % 3 = 0 THEN NULL ELSE lo END AS open,
    CASE WHEN (security_id + rn) % 11 = 0 THEN NULL ELSE hi END AS high,
    CASE WHEN (security_id + rn) % 11 = 0 THEN NULL ELSE lo END AS low,
    close,
    CASE WHEN pc IS NULL THEN close
         WHEN dn % 100 = 0 AND security_id % 4 = 0
           THEN coalesce(pc2, CAST(pc * CAST(0.9 AS DECIMAL(2,1)) AS DECIMAL(20,4)))
         WHEN (security_id * 7 + rn) % 97 = 0 THEN CAST(pc * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(20,4))
         WHEN (security_id * 5 + rn) % 151 = 0 THEN CAST(pc * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(20,4))
         ELSE pc END AS reference_price,
    CASE WHEN (security_id + rn) % 11 = 0 THEN 0 ELSE vol END AS volume,
    CASE WHEN (security_id + rn) % 11 = 0 THEN 0 ELSE val END AS value,
    CASE WHEN (security_id + rn) % 11 = 0 THEN 0 ELSE freq END AS frequency,
    CASE WHEN (security_id + rn) % 11 = 0 THEN 'no_regular_market_trade' ELSE 'traded' END AS trading_status,
    (security_id + rn) % 7 = 0 AS f_nonreg,
    isodow(trading_date) >= 6 AS f_weekend,
    security_id + 1 AS file_id, rn + 1 AS source_line, 'run-1' AS ingestion_run_id
  FROM lagged""",
    "lagged",
)
cte(
    "flagged_bars",
    """SELECT *, CASE WHEN f_nonreg AND f_weekend THEN 'non_regular_activity_present|unverified_trading_date'
    WHEN f_nonreg THEN 'non_regular_activity_present'
    WHEN f_weekend THEN 'unverified_trading_date' ELSE '' END AS flags
  FROM bars""",
    "bars",
)
cte(
    "prev_rows",
    """SELECT security_id, trading_date, close, reference_price, file_id, source_line,
    lag(trading_date) OVER w AS prev_trading_date, lag(close) OVER w AS prev_close,
    lag(file_id) OVER w AS prev_file_id, lag(source_line) OVER w AS prev_source_line,
    lag(close, 2) OVER w AS prev2_close
  FROM bars WINDOW w AS (PARTITION BY security_id ORDER BY trading_date)""",
    "bars",
)
cte(
    "date_stats",
    """SELECT trading_date, count(*) FILTER (WHERE reference_price <> prev_close) AS mismatched_securities,
    count(*) AS compared_securities,
    count(*) FILTER (WHERE reference_price <> prev_close AND reference_price = prev2_close) AS shifted_row_matches
  FROM prev_rows WHERE prev_close IS NOT NULL AND reference_price IS NOT NULL GROUP BY trading_date""",
    "prev_rows",
)
cte(
    "anomalies",
    """SELECT * FROM date_stats WHERE mismatched_securities > 0
    AND mismatched_securities >= CAST(0.20 AS DECIMAL(3,2)) * compared_securities""",
    "date_stats",
)
cte(
    "breaks",
    """SELECT * FROM prev_rows WHERE prev_close IS NOT NULL AND reference_price IS NOT NULL
    AND reference_price <> prev_close""",
    "prev_rows",
)
cte(
    "ca_events",
    """SELECT o_orderkey AS event_id, o_custkey % (SELECT count(*) FROM supplier) AS security_id,
    CAST(o_orderdate AS DATE) AS registration_date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'stockSplit' WHEN '2-HIGH' THEN 'reverseStock'
      WHEN '3-MEDIUM' THEN 'hmetd' WHEN '4-NOT SPECIFIED' THEN 'sahamBonus'
      WHEN '5-LOW' THEN 'dividenSaham' END AS source_category,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'split' WHEN '2-HIGH' THEN 'reverse_split'
      WHEN '3-MEDIUM' THEN 'rights' WHEN '4-NOT SPECIFIED' THEN 'bonus'
      WHEN '5-LOW' THEN 'stock_dividend' END AS label
  FROM orders""",
)
cte(
    "matched",
    """SELECT security_id, trading_date, event_id, label FROM (
    SELECT b.security_id, b.trading_date, e.event_id, e.label,
      row_number() OVER (PARTITION BY b.security_id, b.trading_date
        ORDER BY date_diff('day', b.trading_date, e.registration_date), e.event_id) AS k
    FROM breaks b JOIN ca_events e ON e.security_id = b.security_id
     AND CASE WHEN e.label IN ('split', 'reverse_split') THEN e.registration_date = b.trading_date
              ELSE date_diff('day', b.trading_date, e.registration_date) BETWEEN 0 AND 28 END) x
  WHERE k = 1""",
    "breaks",
    "ca_events",
)
cte(
    "price_factors",
    """SELECT b.*, coalesce(m.label, 'unclassified') AS classification, m.event_id,
    CASE WHEN a.trading_date IS NOT NULL AND coalesce(m.label, '') NOT IN ('split', 'reverse_split')
      THEN 'excluded_market_wide_anomaly' ELSE 'applied' END AS status
  FROM breaks b LEFT JOIN matched m USING (security_id, trading_date)
  LEFT JOIN anomalies a USING (trading_date)""",
    "breaks",
    "matched",
    "anomalies",
)
cte(
    "raw_div",
    """SELECT o_orderkey AS dividend_id, o_custkey % (SELECT count(*) FROM supplier) AS security_id,
    CAST(o_orderdate AS DATE) + CAST(CASE o_orderkey % 4 WHEN 3 THEN -30 WHEN 1 THEN 120 ELSE 0 END AS INTEGER) AS ex_date,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,2)) AS amount
  FROM orders""",
)
cte(
    "div_by_ex",
    "SELECT security_id, ex_date, sum(amount) AS amount FROM raw_div GROUP BY security_id, ex_date",
    "raw_div",
)
cte(
    "placed",
    """SELECT d.security_id, d.ex_date, d.amount, r.trading_date AS effective_date, b.close,
    b.reference_price, b.file_id, b.source_line,
    CASE WHEN NOT EXISTS (SELECT 1 FROM bars q WHERE q.security_id = d.security_id AND q.trading_date <= d.ex_date)
           THEN 'skipped_before_first_row'
         WHEN r.trading_date IS NULL THEN 'skipped_no_traded_row' ELSE 'applied' END AS outcome
  FROM div_by_ex d
  LEFT JOIN (SELECT x.security_id, x.ex_date, min(p.trading_date) AS trading_date
             FROM div_by_ex x JOIN bars p ON p.security_id = x.security_id
               AND p.trading_date >= x.ex_date AND p.trading_status = 'traded'
             GROUP BY x.security_id, x.ex_date) r USING (security_id, ex_date)
  LEFT JOIN bars b ON b.security_id = d.security_id AND b.trading_date = r.trading_date""",
    "div_by_ex",
    "bars",
)
cte(
    "merged_div",
    """SELECT security_id, effective_date, sum(amount) AS amount, min(ex_date) AS source_ex_date,
    count(*) AS records, min(close) AS close, min(reference_price) AS reference_price,
    min(file_id) AS file_id, min(source_line) AS source_line
  FROM placed WHERE outcome = 'applied' GROUP BY security_id, effective_date""",
    "placed",
)
cte(
    "all_factors",
    """SELECT security_id, trading_date AS effective_date, 'price' AS factor_kind,
    CAST(reference_price AS DOUBLE) / CAST(prev_close AS DOUBLE) AS factor, classification, status,
    reference_price, close, prev_trading_date, prev_close, NULL AS dividend_amount,
    CAST(NULL AS DATE) AS source_ex_date, event_id, file_id, source_line, prev_file_id, prev_source_line
  FROM price_factors
  UNION ALL
  SELECT security_id, effective_date, 'cash_dividend',
    CAST(close AS DOUBLE) / (CAST(close AS DOUBLE) + CAST(amount AS DOUBLE)), 'cash_dividend', 'applied',
    reference_price, close, NULL, NULL, amount, source_ex_date, NULL, file_id, source_line, NULL, NULL
  FROM merged_div""",
    "price_factors",
    "merged_div",
)
cte(
    "steps",
    """SELECT security_id, effective_date AS trading_date,
    coalesce(max(factor) FILTER (WHERE factor_kind = 'price'), 1) AS pf,
    coalesce(max(factor) FILTER (WHERE factor_kind = 'cash_dividend'), 1) AS df,
    max(dividend_amount) AS amount
  FROM all_factors WHERE status = 'applied' GROUP BY security_id, effective_date""",
    "all_factors",
)
cte(
    "series",
    """SELECT b.security_id, b.trading_date, b.close, b.reference_price,
    CAST(b.close AS DOUBLE) / CAST(b.reference_price AS DOUBLE) - 1 AS price_return,
    (CAST(b.close AS DOUBLE) + CAST(coalesce(s.amount, 0) AS DOUBLE)) / CAST(b.reference_price AS DOUBLE) - 1 AS total_return,
    coalesce(s.amount, 0) AS dividend,
    CAST(b.close AS DOUBLE) * coalesce(product(coalesce(s.pf, 1)) OVER w, 1) AS adj_close,
    CAST(b.close AS DOUBLE) * coalesce(product(coalesce(s.pf, 1) * coalesce(s.df, 1)) OVER w, 1) AS tr_adj_close,
    a.trading_date IS NULL AS reliable
  FROM bars b LEFT JOIN steps s USING (security_id, trading_date)
  LEFT JOIN anomalies a USING (trading_date)
  WINDOW w AS (PARTITION BY b.security_id ORDER BY b.trading_date
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "bars",
    "steps",
    "anomalies",
)
cte(
    "index_daily",
    """SELECT r_name AS index_code, CAST(l_shipdate AS DATE) AS trading_date,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS close
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2""",
)
cte(
    "index_prev",
    """SELECT *, row_number() OVER w AS rn, lag(close) OVER w AS pc FROM index_daily
  WINDOW w AS (PARTITION BY index_code ORDER BY trading_date)""",
    "index_daily",
)
cte(
    "index_values",
    """SELECT 'bench' AS source_id, index_code, trading_date, rn, close, previous,
    CAST(greatest(close, previous) * CAST(1.01 AS DECIMAL(3,2)) AS DECIMAL(20,4)) AS high,
    CAST(least(close, previous) * CAST(0.99 AS DECIMAL(3,2)) AS DECIMAL(20,4)) AS low,
    isodow(trading_date) >= 6 AS f_weekend
  FROM (SELECT *, coalesce(CASE WHEN rn % 50 = 0 THEN CAST(pc * CAST(0.99 AS DECIMAL(3,2)) AS DECIMAL(20,4)) ELSE pc END, close) AS previous
        FROM index_prev) x""",
    "index_prev",
)

cte(
    "base_flags",
    """SELECT *, list_concat(CASE WHEN f_nonreg THEN ['non_regular_activity_present'] ELSE CAST([] AS VARCHAR[]) END,
    CASE WHEN f_weekend THEN ['unverified_trading_date'] ELSE CAST([] AS VARCHAR[]) END) AS fl FROM bars""",
    "bars",
)
cte(
    "dirty_high",
    """SELECT * REPLACE (
    CASE WHEN (security_id * 3 + rn) % 101 = 0 THEN -1 - volume ELSE volume END AS volume,
    CASE WHEN (security_id + rn * 2) % 103 = 0 THEN low - 1 ELSE high END AS high,
    CASE WHEN (security_id * 2 + rn) % 109 = 0 THEN 0 ELSE close END AS close,
    CASE WHEN (security_id + rn * 11) % 137 = 0 THEN NULL ELSE value END AS value,
    CASE WHEN (security_id + rn * 13) % 139 = 0 THEN -reference_price ELSE reference_price END AS reference_price,
    CASE WHEN (security_id + rn * 5) % 113 = 0 THEN 'unknown' WHEN (security_id + rn) % 127 = 0 THEN 'traded'
      WHEN (security_id + rn * 7) % 131 = 0 THEN 'halted' ELSE trading_status END AS trading_status,
    CASE WHEN (security_id + rn * 17) % 149 = 0 THEN list_append(fl, 'made_up')
      WHEN (security_id + rn * 19) % 151 = 0 THEN list_append(list_reverse(fl), 'unverified_trading_date')
      WHEN (security_id + rn * 23) % 157 = 0 THEN list_append(fl, NULL) ELSE fl END AS fl,
    CASE WHEN rn % 211 = 0 THEN 2 ELSE source_line END AS source_line,
    CASE WHEN security_id % 31 = 0 THEN 'run-2' ELSE 'run-1' END AS ingestion_run_id),
    CASE WHEN (security_id + rn * 3) % 107 = 0 THEN high + 1 ELSE open END AS open2
  FROM base_flags""",
    "base_flags",
)
cte("dirty", "SELECT * EXCLUDE (open, open2), open2 AS open FROM dirty_high", "dirty_high")
cte(
    "issues",
    """SELECT *, concat_ws('|',
    CASE WHEN volume < 0 THEN 'negative_volume' END,
    CASE WHEN open <= 0 THEN 'non_positive_open' END,
    CASE WHEN high <= 0 THEN 'non_positive_high' END,
    CASE WHEN low <= 0 THEN 'non_positive_low' END,
    CASE WHEN close <= 0 THEN 'non_positive_close' END,
    CASE WHEN trading_status = 'traded' AND (high IS NULL OR low IS NULL) THEN 'traded_without_range' END,
    CASE WHEN trading_status = 'traded' AND low IS NOT NULL AND high < low THEN 'high_below_low' END,
    CASE WHEN trading_status = 'traded' AND low IS NOT NULL AND high < close THEN 'high_below_close' END,
    CASE WHEN trading_status = 'traded' AND high IS NOT NULL AND low > close THEN 'low_above_close' END,
    CASE WHEN trading_status = 'traded' AND low IS NOT NULL AND high < open THEN 'high_below_open' END,
    CASE WHEN trading_status = 'traded' AND high IS NOT NULL AND low > open THEN 'low_above_open' END) AS hard,
    concat_ws('|',
    CASE WHEN trading_status = 'no_regular_market_trade' THEN 'no_regular_market_trade' END,
    CASE WHEN trading_status = 'unknown' THEN 'unclassified_row' END,
    CASE WHEN open IS NULL THEN 'open_missing' END) AS expected
  FROM dirty""",
    "dirty",
)
cte(
    "files",
    """SELECT s_suppkey + 1 AS file_id, CASE WHEN s_suppkey % 37 = 0 THEN 'other:r1:0' ELSE 'bench:r1:0' END AS snapshot_id,
    'dataset/stocks/csv/S' || s_suppkey || '.csv' AS relative_path, sha256('file' || s_suppkey) AS sha256,
    coalesce(n, 0) - CASE WHEN s_suppkey % 9 = 0 THEN 1 ELSE 0 END AS row_count,
    CASE WHEN s_suppkey % 13 <> 0 THEN CASE WHEN s_suppkey % 19 = 0 THEN 'X' ELSE 'S' END || s_suppkey END AS source_key
  FROM supplier LEFT JOIN (SELECT security_id, count(*) AS n FROM bars GROUP BY 1) b ON b.security_id = s_suppkey
  WHERE s_suppkey % 17 <> 0""",
    "bars",
)
cte(
    "keys",
    """SELECT 'bench' AS source_id, 'S' || s_suppkey AS source_key, s_suppkey AS security_id,
    CASE WHEN s_suppkey % 29 = 0 THEN ['made_up'] WHEN s_suppkey % 7 = 0 THEN ['source_ticker_column_mismatch']
      ELSE CAST([] AS VARCHAR[]) END AS fl
  FROM supplier WHERE s_suppkey % 23 <> 0""",
)
cte(
    "securities",
    """SELECT s_suppkey AS security_id, CASE WHEN s_suppkey % 41 = 0 THEN 'T' ELSE 'S' END || s_suppkey AS ticker,
    s_name AS name, CASE WHEN s_suppkey % 43 = 0 THEN 'isin' ELSE 'development' END AS identity_kind FROM supplier""",
)
cte(
    "snapshots",
    """SELECT snapshot_key, CASE WHEN snapshot_key % 50 = 0 THEN d || 'x' ELSE d END AS snapshot_id,
    CASE WHEN snapshot_key % 60 = 0 THEN upper(src) ELSE src END AS source_id, source_revision,
    CASE WHEN snapshot_key % 70 = 0 THEN upper(h) ELSE h END AS content_sha256,
    CASE WHEN snapshot_key % 80 = 0 THEN 'short' END AS archive_sha256,
    CASE WHEN snapshot_key % 90 = 0 THEN -1 ELSE snapshot_key % 100 END AS file_count
  FROM (SELECT *, src || ':' || source_revision || ':' || substr(h, 1, 16) AS d
        FROM (SELECT c_custkey AS snapshot_key, lower(c_mktsegment) AS src, 'r' || c_nationkey AS source_revision,
                sha256(CAST(c_custkey AS VARCHAR)) AS h FROM customer) a) b""",
)
cte(
    "runs",
    """SELECT CAST(o_orderkey AS VARCHAR) AS ingestion_run_id, snapshot_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'stock-csv-1' ELSE 'index-csv-1' END AS parser_version,
    CAST(o_orderdate AS DATE) AS started,
    CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 120 = 0
      THEN CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 130 = 0 THEN -1 ELSE 1 END END AS completed,
    CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'succeeded' ELSE 'failed' END AS status,
    o_orderkey % 1000 AS rows_seen,
    o_orderkey % 1000 - CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 ELSE 0 END
      - CASE WHEN o_orderkey % 111 = 0 THEN 1 ELSE 0 END AS rows_inserted,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 ELSE 0 END AS collapsed
  FROM orders JOIN snapshots ON o_custkey = snapshot_key""",
    "snapshots",
)

cte(
    "incoming",
    "SELECT *, 'S' || security_id AS source_key FROM flagged_bars",
    "flagged_bars",
)
cte(
    "stored",
    """SELECT * REPLACE (CASE WHEN (security_id + rn) % 37 = 0 THEN close + 1 ELSE close END AS close)
  FROM flagged_bars WHERE rn % 10 <> 0""",
    "flagged_bars",
)
cte(
    "outcomes",
    """SELECT security_id, trading_date, rn, close, source_line, CASE WHEN rn % 10 = 0 THEN 'new'
    WHEN (security_id + rn) % 37 = 0 THEN 'conflict' ELSE 'unchanged' END AS outcome FROM bars""",
    "bars",
)
cte(
    "copies",
    """SELECT security_id, trading_date, rn, close, rn + 1 AS line FROM bars
  UNION ALL SELECT security_id, trading_date, rn, close, rn + 100001 FROM bars WHERE rn % 50 = 0
  UNION ALL SELECT security_id, trading_date, rn, close + 1, rn + 200001 FROM bars WHERE rn % 400 = 0 AND security_id % 5 = 0""",
    "bars",
)
cte(
    "copy_groups",
    """SELECT security_id, trading_date, count(*) AS copies, count(DISTINCT close) > 1 AS conflict, min(line) AS line
  FROM copies GROUP BY security_id, trading_date""",
    "copies",
)

cte(
    "stock_lines",
    """SELECT *, 'S' || security_id || 'Y' || year(trading_date) AS k,
    CASE WHEN security_id % 4 = 0 THEN 'Company ' || security_id || ', "Y' || rn || '"'
      ELSE 'Company ' || security_id || ' Y' || rn END AS company,
    row_number() OVER (PARTITION BY security_id, year(trading_date) ORDER BY trading_date DESC) + 1 AS line,
    CASE WHEN rn % 83 = 0 THEN '2 fields, expected 26'
      WHEN rn % 97 = 0 THEN 'malformed date ''' || replace(CAST(trading_date AS VARCHAR), '-', '/') || ''''
      WHEN rn % 89 = 0 THEN 'Close=''n/a'' is not a number' END AS reason
  FROM flagged_bars""",
    "flagged_bars",
)
cte(
    "index_lines",
    """SELECT *, replace(index_code, ' ', '-') || '-' || year(trading_date) AS code,
    row_number() OVER (PARTITION BY index_code, year(trading_date) ORDER BY trading_date DESC) + 1 AS line,
    CASE WHEN rn % 41 = 0 AND month(trading_date) < 10 THEN 'Date=''' || strftime(trading_date, '%Y-%-m-%d') || ''' is not YYYY-MM-DD'
      ELSE coalesce(nullif(concat_ws('|',
        CASE WHEN rn % 37 = 0 AND close - 1 < low THEN 'high_below_low' END,
        CASE WHEN rn % 37 = 0 THEN 'close_outside_high_low' END,
        CASE WHEN rn % 31 = 0 THEN 'change_differs_from_close_minus_previous' END), ''),
        CASE WHEN rn % 43 = 0 THEN 'Constituent=''9.5'' is not an integer' END) END AS reason
  FROM index_values""",
    "index_values",
)
cte(
    "event_records",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, o_custkey,
    'categories.' || o_orderpriority || '.data[' || (row_number() OVER (PARTITION BY o_orderkey // 1000, o_orderpriority ORDER BY o_orderkey) - 1) || ']' AS ref,
    o_orderkey // 1000 AS block,
    CASE WHEN o_orderkey % 19 = 0 THEN 'missing fields JumlahSaham'
      WHEN o_orderkey % 13 = 0 THEN 'unexpected date ''' || CAST(o_orderdate AS DATE) || 'T10:00:00'''
      WHEN o_orderkey % 17 = 0 THEN 'empty ticker'
      WHEN o_orderkey % 5 <> 0 AND o_orderkey % 23 = 0 THEN 'JumlahSaham: invalid share count ''' || (o_orderkey % 900 - 1000) || '''' END AS reason
  FROM orders""",
)
cte(
    "dividend_records",
    """SELECT *, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderkey // 1000 AS block,
    'S' || (o_custkey % 100) || '.JK[' || (row_number() OVER (PARTITION BY o_orderkey // 1000, o_custkey % 100 ORDER BY o_orderkey) - 1) || ']' AS ref,
    CASE WHEN o_orderkey % 11 = 0 THEN 'dividend: not a positive amount ''-' || CAST(o_totalprice AS DECIMAL(18,2)) || ''''
      WHEN o_orderkey % 17 = 0 THEN 'fiscal_year: unexpected value ''19'''
      WHEN o_orderkey % 29 = 0 THEN 'dividend_type: unexpected value '''''
      WHEN o_orderkey % 13 = 0 AND month(o_orderdate) < 10 THEN 'ex_date: unexpected date ''' || strftime(o_orderdate, '%Y-%-m-%d') || '''' END AS reason
  FROM orders""",
)
