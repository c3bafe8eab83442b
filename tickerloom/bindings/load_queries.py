"""Duplicates, idempotent upsert, links, comparison, run bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.bindings import derived
from tickerloom.bindings.derived import SOURCE, Tables
from tickerloom.bindings.registry import query
from tickerloom.functions.digest import row_fingerprint
from tickerloom.functions.normalize import normalize_ticker, record_ref
from tickerloom.operators import compare, dedupe, upsert
from tickerloom.operators.ids import with_dense_ids
from tickerloom.operators.quality import role_counts
from tickerloom.plans import factors, load_records, verify
from tickerloom.plans.durable import durable
from tickerloom.plans.incidents import draft, new_incidents
from tickerloom.plans.load_prices import compared_rows, conflict_drafts, resolve_securities
from tickerloom.plans.registration import balance, outcome_rows
from tickerloom.schemas import (
    DIVIDEND_OBSERVATION,
    FILE_ROLES,
    PRICE_KEY,
    PRICE_OBSERVATION,
    PRICE_PROVENANCE,
    ROW_OUTCOMES,
)
from tickerloom.sources.adapters import StockCsvSource
from tickerloom.sources.snapshot import listing_hashes, snapshot_id


def copies(t: Tables) -> DataFrame:
    """Bars with exact copies and, for some securities, conflicting copies."""
    bars = t.numbered_bars.withColumn("line", F.col("source_line").cast("bigint"))
    exact = bars.filter("rn % 50 = 0").withColumn("line", F.col("line") + 100000)
    other = bars.filter("rn % 400 = 0 AND security_id % 5 = 0").withColumns(
        {"line": F.col("line") + 200000, "close": (F.col("close") + 1).cast("decimal(20,4)")}
    )
    return bars.unionByName(exact).unionByName(other)


def copy_groups(t: Tables) -> DataFrame:
    return dedupe.key_groups(
        copies(t),
        ["security_id", "trading_date"],
        PRICE_OBSERVATION,
        F.col("line"),
        ["line", *PRICE_OBSERVATION],
    )


def stored(t: Tables) -> DataFrame:
    """The stored side: a tenth of the bars missing, some closes different."""
    sid, rn = F.col("security_id"), F.col("rn")
    changed = (F.col("close") + 1).cast("decimal(20,4)")
    return t.numbered_bars.filter(rn % 10 != 0).withColumn(
        "close", F.when((sid + rn) % 37 == 0, changed).otherwise(F.col("close"))
    )


def classified(t: Tables) -> DataFrame:
    return upsert.classify(
        t.numbered_bars,
        stored(t),
        PRICE_KEY,
        PRICE_OBSERVATION,
        [*PRICE_PROVENANCE, "ingestion_run_id"],
        rows=t.bars.count(),
    )


# ----------------------------------------------------------------- duplicates


@query(
    "a3_duplicate_groups",
    "SELECT security_id, trading_date, copies, conflict, line FROM copy_groups WHERE copies > 1",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    return copy_groups(t).filter("copies > 1").select(
        "security_id", "trading_date", "copies", "conflict", "line"
    )


@query(
    "a3_rejected_batches",
    "SELECT DISTINCT security_id FROM copy_groups WHERE conflict",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    return dedupe.batch_conflicts(copy_groups(t), ["security_id"])


@query(
    "a3_accepted_rows",
    """SELECT security_id, trading_date, line FROM copy_groups
    WHERE security_id NOT IN (SELECT security_id FROM copy_groups WHERE conflict)""",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    return dedupe.accepted(copy_groups(t), ["security_id"]).select(
        "security_id", "trading_date", "line"
    )


@query(
    "w7_lowest_line",
    """SELECT security_id, trading_date, line FROM copy_groups WHERE copies > 1 AND NOT conflict""",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    kept = copy_groups(t).filter("copies > 1 AND NOT conflict")
    return kept.select("security_id", "trading_date", "line")


@query(
    "a4_exact_duplicates_resolved",
    """SELECT count(*) FILTER (WHERE NOT conflict) AS kept,
      CAST(sum(copies - 1) FILTER (WHERE NOT conflict) AS BIGINT) AS dropped,
      count(*) FILTER (WHERE conflict) AS refused, TRUE AS refuses_all FROM copy_groups""",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    key = ["security_id", "trading_date"]
    groups = durable(copy_groups(t))
    try:
        dedupe.require_no_conflicts(groups, key)
        refuses = groups.filter("conflict").isEmpty()
    except dedupe.ConflictingDuplicates:
        refuses = True
    dedupe.require_no_conflicts(dedupe.accepted(groups), key)
    clean = ~F.col("conflict")
    return groups.agg(
        F.count(F.when(clean, 1)).alias("kept"),
        F.sum(F.when(clean, F.col("copies") - 1)).alias("dropped"),
        F.count(F.when(F.col("conflict"), 1)).alias("refused"),
    ).withColumn("refuses_all", F.lit(refuses))


@query(
    "a5_record_duplicates",
    """SELECT security_id, ex_date, count(*) AS copies, count(DISTINCT amount) > 1 AS conflict,
    min(dividend_id) AS first_record FROM raw_div GROUP BY security_id, ex_date""",
    "raw_div",
)
def _(t: Tables) -> DataFrame:
    return dedupe.key_groups(
        t.dividends,
        ["security_id", "ex_date"],
        DIVIDEND_OBSERVATION,
        F.col("dividend_id"),
        ["dividend_id"],
    ).select(
        "security_id", "ex_date", "copies", "conflict", F.col("dividend_id").alias("first_record")
    )


@query(
    "a6_run_counters",
    """SELECT count(*) AS rows_seen, count(*) FILTER (WHERE o.outcome = 'new') AS rows_inserted,
    count(*) FILTER (WHERE o.outcome = 'unchanged') AS rows_unchanged, CAST(0 AS BIGINT) AS rows_rejected,
    count(*) FILTER (WHERE o.outcome = 'conflict') AS rows_conflicted, CAST(0 AS BIGINT) AS rows_collapsed_duplicates,
    TRUE AS consistent FROM outcomes o""",
    "outcomes",
)
def _(t: Tables) -> DataFrame:
    found = balance(outcome_rows(compared_rows(classified(t))))
    seen = t.bars.agg(F.count(F.lit(1)).alias("rows_seen"))
    # One row on either side.
    return seen.join(found, F.col("rows_accounted") == F.col("rows_seen"), "full_outer").select(
        "rows_seen", *ROW_OUTCOMES, F.col("rows_accounted").eqNullSafe(F.col("rows_seen")).alias("consistent")
    )


@query(
    "a22_staging_guard",
    "SELECT count(*) AS duplicate_keys FROM copy_groups WHERE copies > 1",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    found = dedupe.duplicate_keys(copies(t), PRICE_KEY)
    return found.agg(F.count(F.lit(1)).alias("duplicate_keys"))


# --------------------------------------------------------------------- upsert


@query(
    "j1_upsert_classify",
    "SELECT security_id, trading_date, outcome FROM outcomes",
    "outcomes",
)
def _(t: Tables) -> DataFrame:
    return classified(t).select("security_id", "trading_date", "outcome")


@query(
    "j1_outcome_counts",
    """SELECT count(*) FILTER (WHERE outcome = 'new') AS "new", count(*) FILTER (WHERE outcome = 'unchanged') AS unchanged,
    count(*) FILTER (WHERE outcome = 'conflict') AS conflict FROM outcomes""",
    "outcomes",
)
def _(t: Tables) -> DataFrame:
    return upsert.outcome_counts(classified(t))


@query(
    "j2_conflict_versions",
    """SELECT security_id, trading_date, CAST(close + 1 AS DOUBLE) AS stored_close, CAST(close AS DOUBLE) AS incoming_close
    FROM outcomes WHERE outcome = 'conflict'""",
    "outcomes",
)
def _(t: Tables) -> DataFrame:
    found = classified(t).filter(F.col("outcome") == upsert.CONFLICT)
    return found.select(
        "security_id",
        "trading_date",
        F.col("stored.close").alias("stored_close"),
        F.col("close").alias("incoming_close"),
    )


@query(
    "p19_conflict_details",
    """SELECT security_id AS k, trading_date, CAST(close + 1 AS VARCHAR) AS stored_close, CAST(close AS VARCHAR) AS incoming_close,
    CAST(source_line AS VARCHAR) AS incoming_line FROM outcomes WHERE outcome = 'conflict'""",
    "outcomes",
)
def _(t: Tables) -> DataFrame:
    rows = classified(t).filter(F.col("outcome") == upsert.CONFLICT)
    drafts = conflict_drafts(
        rows.withColumns(
            {"source_key": F.col("security_id").cast("string"), "relative_path": F.lit("f")}
        )
    )

    def field(path: str) -> Column:
        return F.get_json_object("details", path)

    return drafts.select(
        F.col("source_key").cast("bigint").alias("k"),
        "trading_date",
        field("$.stored.close").alias("stored_close"),
        field("$.incoming.close").alias("incoming_close"),
        field("$.incoming_provenance.source_line").alias("incoming_line"),
    )


@query(
    "j3_new_rows",
    "SELECT security_id, trading_date, CAST(close AS DOUBLE) AS close FROM bars WHERE rn % 10 = 0",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return upsert.only_new(t.numbered_bars, stored(t), PRICE_KEY).select(
        "security_id", "trading_date", "close"
    )


def warnings(t: Tables) -> DataFrame:
    """One warning per part name; many parts share a name."""
    return draft(
        t.table("part"),
        "source_ticker_column_mismatch",
        "warning",
        F.struct("p_name", "p_brand"),
        source_key=F.col("p_type"),
    )


@query(
    "p18_incident_fingerprints",
    """SELECT p_type AS source_key, '{"p_name":"' || p_name || '","p_brand":"' || p_brand || '"}' AS details,
    sha256('{"details":"{\\"p_name\\":\\"' || p_name || '\\",\\"p_brand\\":\\"' || p_brand || '\\"}","incident_type":"source_ticker_column_mismatch","relative_path":null,"source_key":"' || p_type || '","source_line":null,"trading_date":null}') AS fingerprint
    FROM part""",
)
def _(t: Tables) -> DataFrame:
    return warnings(t).select("source_key", "details", "fingerprint")


@query(
    "j4_incident_dedup",
    """SELECT count(*) AS new_incidents FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part
    EXCEPT SELECT p_name, p_brand, p_type FROM part WHERE p_size > 25) x""",
)
def _(t: Tables) -> DataFrame:
    parts = t.table("part")
    already = draft(
        parts.filter("p_size > 25"),
        "source_ticker_column_mismatch",
        "warning",
        F.struct("p_name", "p_brand"),
        source_key=F.col("p_type"),
    )
    return new_incidents(warnings(t), already).agg(F.count(F.lit(1)).alias("new_incidents"))


@query(
    "u3_fingerprint_intersection",
    """SELECT count(*) AS found FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part WHERE p_size <= 25
    INTERSECT SELECT p_name, p_brand, p_type FROM part WHERE p_size > 25) x""",
)
def _(t: Tables) -> DataFrame:
    parts = t.table("part")
    kept = ("p_name", "p_brand")
    sides = [
        draft(
            parts.filter(test),
            "source_ticker_column_mismatch",
            "warning",
            F.struct(*kept),
            source_key=F.col("p_type"),
        )
        for test in ("p_size <= 25", "p_size > 25")
    ]
    return verify.matched_fingerprints(*sides).agg(F.count(F.lit(1)).alias("found"))


@query(
    "j5_security_ids",
    """SELECT s.source_key, CASE WHEN k.security_id IS NULL THEN 1000000 + row_number() OVER (PARTITION BY k.security_id IS NULL ORDER BY s.source_key)
      ELSE k.security_id END AS security_id, k.security_id IS NULL AS created,
    k.security_id IS NOT NULL AND (b.d IS NULL OR DATE '2001-06-01' + CAST(s.n % 600 AS INTEGER) > b.d) AS renamed
    FROM (SELECT s_suppkey AS n, 'S' || s_suppkey AS source_key FROM supplier) s
    LEFT JOIN keys k USING (source_key)
    LEFT JOIN (SELECT security_id, max(trading_date) AS d FROM bars GROUP BY 1) b ON b.security_id = k.security_id""",
    "keys",
    "bars",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.plans.load_prices import newest_dates

    supplier = t.table("supplier")
    key = F.col("s_suppkey")
    snapshot = supplier.select(
        F.concat(F.lit("S"), key.cast("string")).alias("source_key"),
        F.date_add(F.lit("2001-06-01").cast("date"), (key % 600).cast("int")).alias("newest_date"),
    )
    return resolve_securities(
        snapshot, derived.derive_keys(supplier), newest_dates(t.bars), 1000000
    ).select("source_key", "security_id", "created", "renamed")


@query(
    "j6_ticker_link",
    """SELECT o.o_orderkey AS record, k.security_id, CASE WHEN k.security_id IS NULL THEN 'unmatched' ELSE 'ticker_text_match' END AS security_match
    FROM orders o LEFT JOIN keys k ON k.source_key = 'S' || (o.o_custkey % 100)""",
    "keys",
)
def _(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" s"), (F.col("o_custkey") % 100).cast("string"), F.lit(" "))
    records = t.table("orders").select(
        F.col("o_orderkey").alias("record"), normalize_ticker(text).alias("match_key")
    )
    linked = load_records.link_securities(records, derived.derive_keys(t.table("supplier")))
    return linked.select("record", "security_id", "security_match")


@query(
    "j7_record_classify",
    """SELECT o_orderkey AS record, CASE WHEN o_orderkey % 7 = 0 THEN 'new' WHEN o_orderkey % 11 = 0 THEN 'conflict' ELSE 'unchanged' END AS outcome
    FROM orders""",
)
def _(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    incoming = t.table("orders").select(
        key.alias("record"), F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    known = incoming.filter("record % 7 <> 0").withColumn(
        "o_totalprice",
        F.when(F.col("record") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    return upsert.classify(incoming, known, ["record"], ["day", "o_totalprice"]).select(
        "record", "outcome"
    )


# ----------------------------------------------------------------- comparison


@query(
    "j13_price_compare",
    """SELECT count(*) FILTER (WHERE rn % 10 = 0) AS missing,
    count(*) FILTER (WHERE rn % 10 <> 0 AND (security_id + rn) % 37 = 0) AS observation_differs,
    count(*) FILTER (WHERE rn % 10 <> 0 AND (security_id + rn) % 37 <> 0 AND rn % 41 = 0) AS provenance_differs,
    count(*) FILTER (WHERE rn % 10 <> 0 AND rn % 83 = 0) AS extra FROM bars""",
    "bars",
)
def _(t: Tables) -> DataFrame:
    line = F.col("source_line")
    have = stored(t).withColumn(
        "source_line", F.when(F.col("rn") % 41 == 0, line + 1).otherwise(line)
    )
    added = stored(t).filter("rn % 83 = 0").withColumn("source_id", F.lit("extra"))
    return compare.compare_tables(
        t.numbered_bars, have.unionByName(added), PRICE_KEY, PRICE_OBSERVATION, PRICE_PROVENANCE
    )


@query(
    "j14_record_compare",
    """SELECT count(*) FILTER (WHERE event_id % 60 = 0) AS missing,
    count(*) FILTER (WHERE event_id % 60 <> 0 AND event_id % 100 = 0) AS observation_differs,
    CAST(0 AS BIGINT) AS provenance_differs, count(*) FILTER (WHERE event_id % 60 <> 0 AND event_id % 70 = 0) AS extra FROM ca_events""",
    "ca_events",
)
def _(t: Tables) -> DataFrame:
    event = F.col("event_id")
    day = F.col("registration_date")
    have = t.events.filter(event % 60 != 0).withColumn(
        "registration_date", F.when(event % 100 == 0, F.date_add(day, 1)).otherwise(day)
    )
    other = F.concat("source_record_id", F.lit("x"))
    have = have.unionByName(have.filter(event % 70 == 0).withColumn("source_record_id", other))
    return compare.compare_by_ranges(
        t.events,
        have,
        {"part": F.pmod(F.xxhash64("source_record_id"), F.lit(512))},
        ["source_record_id"],
        ["source_category", "source_action_label", "source_ticker", "registration_date"],
        ["file_id"],
    )


@query(
    "j15_registration_compare",
    """SELECT count(*) FILTER (WHERE doc_id % 31 = 0) AS missing,
    count(*) FILTER (WHERE doc_id % 31 <> 0 AND doc_id % 13 = 0) AS observation_differs,
    CAST(0 AS BIGINT) AS provenance_differs, count(*) FILTER (WHERE doc_id % 31 <> 0 AND doc_id % 97 = 0) AS extra
    FROM documents""",
)
def _(t: Tables) -> DataFrame:
    doc = F.col("doc_id")
    disk = listing(t)
    registered = disk.filter(doc % 31 != 0)
    changed = registered.withColumn(
        "sha256", F.when(doc % 13 == 0, F.reverse("sha256")).otherwise(F.col("sha256"))
    )
    gone = registered.filter(doc % 97 == 0).withColumn(
        "relative_path", F.concat("relative_path", F.lit(".old"))
    )
    return compare.compare_tables(
        disk, changed.unionByName(gone), ["relative_path"], ["sha256"]
    )


@query(
    "j16_link_without_key",
    """SELECT DISTINCT security_id FROM ca_events WHERE security_id NOT IN (SELECT security_id FROM keys)""",
    "ca_events",
    "keys",
)
def _(t: Tables) -> DataFrame:
    keys = derived.derive_keys(t.table("supplier"))
    return verify.links_without_key(t.events, keys).distinct()


@query(
    "j17_rows_per_file",
    """SELECT f.relative_path, count(b.file_id) AS stored_rows FROM files f LEFT JOIN bars b ON b.file_id = f.file_id
    WHERE f.source_key IS NOT NULL GROUP BY f.relative_path""",
    "files",
)
def _(t: Tables) -> DataFrame:
    return verify.rows_per_file(derived.derive_files(t.table("supplier"), t.bars), verify.price_facts(t.bars))


@query(
    "u4_key_difference",
    "SELECT security_id, trading_date FROM bars WHERE rn % 10 = 0",
    "bars",
)
def _(t: Tables) -> DataFrame:
    return compare.key_difference(t.bars, stored(t), ["security_id", "trading_date"], rows=t.bars.count())


# ------------------------------------------------------- snapshots, files, runs


def listing(t: Tables) -> DataFrame:
    """One file per document; a snapshot is a block of 1000 documents."""
    return t.table("documents").select(
        "doc_id",
        F.floor(F.col("doc_id") / 1000).alias("block"),
        F.concat_ws("/", F.lit("docs"), "lang", F.col("doc_id").cast("string")).alias(
            "relative_path"
        ),
        F.sha2("text", 256).alias("sha256"),
        F.octet_length("text").alias("size_bytes"),
    )


_HASHES = """SELECT doc_id // 1000 AS block, count(*) AS files,
    sha256(string_agg('docs/' || lang || '/' || doc_id || chr(0) || sha256(text) || chr(10), '' ORDER BY 'docs/' || lang || '/' || doc_id)) AS content_sha256
    FROM documents GROUP BY 1"""


@query("s3_listing_hash", _HASHES)
def _(t: Tables) -> DataFrame:
    return listing_hashes(listing(t), ["block"])


@query(
    "s4_snapshot_id",
    f"SELECT 'docs:r' || block || ':' || substr(content_sha256, 1, 16) AS snapshot_id, files FROM ({_HASHES}) h",
)
def _(t: Tables) -> DataFrame:
    hashes = listing_hashes(listing(t), ["block"])
    revision = F.concat(F.lit("r"), F.col("block").cast("string"))
    return hashes.select(
        snapshot_id(F.lit("docs"), revision, F.col("content_sha256")).alias("snapshot_id"), "files"
    )


def paths(t: Tables) -> DataFrame:
    doc = F.col("doc_id")
    name = doc.cast("string")
    path = (
        F.when(doc % 6 == 0, F.concat(F.lit("dataset/stocks/csv/K"), name, F.lit(".csv")))
        .when(doc % 6 == 1, F.concat(F.lit("dataset/stocks/csv/k"), name, F.lit(".csv")))
        .when(doc % 6 == 2, F.concat(F.lit("dataset/indices/csv/"), name, F.lit(".csv")))
        .when(doc % 6 == 3, F.concat(F.lit("dataset/preview/stocks/csv/"), name, F.lit(".csv")))
        .otherwise(F.concat(F.lit("notes/"), name))
    )
    return t.table("documents").select("doc_id", path.alias("relative_path"))


_ROLE = "CASE doc_id % 6 WHEN 0 THEN 'stock' WHEN 1 THEN NULL WHEN 2 THEN 'index' WHEN 3 THEN 'preview' ELSE 'other' END"


@query("s6_file_roles", f"SELECT doc_id, {_ROLE} AS role FROM documents")
def _(t: Tables) -> DataFrame:
    role = StockCsvSource(SOURCE).classify(F.col("relative_path"))
    return paths(t).select("doc_id", role.alias("role"))


@query(
    "a20_role_counts",
    f"""SELECT r.role, count(d.role) AS files FROM (SELECT unnest(['stock', 'index', 'preview', 'other']) AS role) r
    LEFT JOIN (SELECT {_ROLE} AS role FROM documents) d USING (role) GROUP BY r.role""",
)
def _(t: Tables) -> DataFrame:
    role = StockCsvSource(SOURCE).classify(F.col("relative_path"))
    return role_counts(paths(t).withColumn("role", role), FILE_ROLES)


@query(
    "j20_revision_mismatch",
    """SELECT a.snapshot_id, count(*) AS others FROM snapshots a JOIN snapshots b
    ON a.source_id = b.source_id AND a.source_revision = b.source_revision AND a.content_sha256 <> b.content_sha256
    GROUP BY a.snapshot_id""",
    "snapshots",
)
def _(t: Tables) -> DataFrame:
    snapshots = derived.derive_snapshots(t.table("customer"))
    per_revision = ["source_id", "source_revision"]
    # Counting per revision and per content gives the number of other snapshots
    # without pairing them.
    total = snapshots.groupBy(*per_revision).agg(F.count(F.lit(1)).alias("all"))
    same = snapshots.groupBy(*per_revision, "content_sha256").agg(F.count(F.lit(1)).alias("same"))
    return (
        snapshots.join(total, per_revision)
        .join(same, [*per_revision, "content_sha256"])
        .groupBy("snapshot_id")
        .agg(F.sum(F.col("all") - F.col("same")).alias("others"))
        .filter("others > 0")
    )


@query(
    "t2_latest_run",
    """SELECT parser_version, max(rows_seen) AS rows_seen FROM (SELECT *, rank() OVER (PARTITION BY parser_version ORDER BY completed DESC) AS k
      FROM runs WHERE status = 'succeeded') r WHERE k = 1 GROUP BY parser_version""",
    "runs",
)
def _(t: Tables) -> DataFrame:
    # Many runs complete on one day here; the row of the highest version is the latest.
    runs = derived.derive_runs(t.table("orders"), t.table("customer")).withColumn("version", F.col("rows_seen"))
    succeeded = runs.filter("status = 'succeeded'")
    found = [(p, verify.latest_rows_seen(succeeded, p)) for p in ("stock-csv-1", "index-csv-1")]
    return t.spark.createDataFrame(found, "parser_version string, rows_seen bigint")


@query(
    "s22_succeeded_snapshots",
    """SELECT DISTINCT s.snapshot_id FROM snapshots s JOIN runs r USING (snapshot_id)
    WHERE s.source_id = 'building' AND r.status = 'succeeded'""",
    "snapshots",
    "runs",
)
def _(t: Tables) -> DataFrame:
    snapshots = derived.derive_snapshots(t.table("customer")).filter("source_id = 'building'")
    runs = derived.derive_runs(t.table("orders"), t.table("customer"))
    return factors.distinct_succeeded(snapshots, runs)


@query(
    "p9_record_ref",
    """SELECT doc_id, 'docs/' || lang || '/' || doc_id || '@sha256:' || sha256(text) || '#line=' || (doc_id % 50) AS ref
    FROM documents""",
)
def _(t: Tables) -> DataFrame:
    ref = record_ref(F.col("relative_path"), F.col("sha256"), F.col("doc_id") % 50)
    return listing(t).select("doc_id", ref.alias("ref"))


@query(
    "p17_json_details",
    """SELECT o_orderkey, '{"amount":"' || printf('%.2f', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)) || '","day":"' || CAST(o_orderdate AS DATE) || '"}' AS details
    FROM orders""",
)
def _(t: Tables) -> DataFrame:
    from tickerloom.plans.incidents import as_text

    rows = t.table("orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.to_date("o_orderdate").alias("day"),
    )
    return rows.select("o_orderkey", F.to_json(as_text("amount", "day")).alias("details"))


@query(
    "p18_row_fingerprints",
    """SELECT o_orderkey, sha256(concat_ws(chr(31), CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority)) AS fingerprint FROM orders""",
)
def _(t: Tables) -> DataFrame:
    columns = [F.col(c) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")]
    return t.table("orders").select("o_orderkey", row_fingerprint(columns).alias("fingerprint"))


@query(
    "j5_dense_ids",
    """SELECT s_name, row_number() OVER (ORDER BY s_name) AS id FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    return with_dense_ids(t.table("supplier").select("s_name"), "s_name", "id", 0)
