"""Snapshot folders, structural errors, sorted sinks and reads of one security."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.bindings import job_queries, jobs  # noqa: F401  (job_queries names check SQL)
from tickerloom.bindings.derived import Tables
from tickerloom.bindings.files import stock_edition
from tickerloom.bindings.folders import folder
from tickerloom.bindings.load_queries import copy_groups
from tickerloom.bindings.registry import cte, query
from tickerloom.bindings.series_queries import build
from tickerloom.operators.dedupe import ConflictingDuplicates, require_no_conflicts
from tickerloom.plans import factors
from tickerloom.plans.load_prices import quarantine
from tickerloom.plans.registration import prepare_prices
from tickerloom.plans.store import Store
from tickerloom.sources.adapters import ActionsJsonSource
from tickerloom.sources.provider import InvalidPrices, SnapshotPrices, UnknownSecurity
from tickerloom.sources.snapshot import StructuralError, listed_files, snapshot_files

# -------------------------------------------------------------------- folders

_NAME = """CASE WHEN doc_id % 7 = 0 THEN '_old/' WHEN doc_id % 11 = 0 THEN '.cache/deep/' ELSE '' END
    || 'docs/' || lang || '/' || CASE WHEN doc_id % 13 = 0 THEN '.' ELSE '' END || doc_id"""
_BODY = "CASE WHEN doc_id % 17 = 0 THEN '' ELSE text END"


def document_folder(t: Tables) -> str:
    """Documents as files, some hidden, in hidden folders, or without a byte."""
    doc = F.col("doc_id")
    path = F.concat(
        F.when(doc % 7 == 0, "_old/").when(doc % 11 == 0, ".cache/deep/").otherwise(""),
        F.lit("docs/"),
        F.col("lang"),
        F.lit("/"),
        F.when(doc % 13 == 0, ".").otherwise(""),
        doc.cast("string"),
    )
    content = F.encode(F.when(doc % 17 == 0, "").otherwise(F.col("text")), "UTF-8")
    return folder(t, "documents", t.table("documents").select(path.alias("relative_path"), content.alias("content")))


@query("s1_file_listing", f"SELECT {_NAME} AS relative_path, octet_length(encode({_BODY})) AS size_bytes FROM documents")
def _(t: Tables) -> DataFrame:
    return listed_files(t.spark, document_folder(t))


@query(
    "s2_file_hashes",
    f"""SELECT {_NAME} AS relative_path, octet_length(encode({_BODY})) AS size_bytes, sha256({_BODY}) AS sha256,
    {_BODY} AS text FROM documents""",
)
def _(t: Tables) -> DataFrame:
    files = snapshot_files(t.spark, document_folder(t))
    return files.select("relative_path", "size_bytes", "sha256", F.col("content").cast("string").alias("text"))


@query(
    "s17_data_files",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'dataset/indices/csv/I' || o_orderkey || '.csv'
      WHEN 1 THEN 'dataset/indices/csv/I_' || o_orderkey || '.csv' WHEN 2 THEN 'dataset/indices/' || o_orderkey || '.csv'
      WHEN 3 THEN 'data/corporateActions.json' ELSE 'dataset/indices/csv/I' || o_orderkey || '.bak' END AS relative_path,
    o_orderkey % 5 = 0 AS index_file, o_orderkey % 5 IN (1, 4) AS stray, o_orderkey % 5 = 3 AS event_file FROM orders""",
)
def _(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    path = (
        F.when(key % 5 == 0, F.concat(F.lit("dataset/indices/csv/I"), text, F.lit(".csv")))
        .when(key % 5 == 1, F.concat(F.lit("dataset/indices/csv/I_"), text, F.lit(".csv")))
        .when(key % 5 == 2, F.concat(F.lit("dataset/indices/"), text, F.lit(".csv")))
        .when(key % 5 == 3, "data/corporateActions.json")
        .otherwise(F.concat(F.lit("dataset/indices/csv/I"), text, F.lit(".bak")))
    )
    named = F.col("relative_path")
    return t.table("orders").select("o_orderkey", path.alias("relative_path")).select(
        "o_orderkey",
        named,
        jobs.INDEX.is_data_file(named).alias("index_file"),
        jobs.INDEX.is_unexpected(named).alias("stray"),
        ActionsJsonSource("x").is_data_file(named).alias("event_file"),
    )


cte("file_names", "SELECT k, 'dataset/stocks/csv/' || k || '.csv' AS p FROM file_1", "file_1")


def _five(text: str, digit: int, between: str) -> str:
    """Check SQL: the five least of the files whose key ends in a digit."""
    least = f"SELECT * FROM file_names WHERE k LIKE '%{digit}' ORDER BY p LIMIT 5"
    return f"(SELECT string_agg({text}, '{between}' ORDER BY p) FROM ({least}) f)"


def _listed(text: str, digit: int) -> str:
    return "'[' || " + _five(f"chr(39) || {text} || chr(39)", digit, ", ") + " || ']'"


_PROBLEMS = {
    "changed header": _five("p || ': unexpected header'", 5, "; "),
    "not UTF-8": _five("p || ': not valid UTF-8'", 6, "; "),
    "stray files": "'unexpected file in stock folder: ' || " + _listed("replace(p, '.csv', '.CSV')", 7),
    "too few": "'expected 1 stock files, found ' || (SELECT count(*) FROM file_1)",
    "twice": "'keys in more than one file: ' || " + _listed("k", 8),
    "none": "'no stock files found under editions/1'",
}


@query(
    "s19_structural_problems",
    " UNION ALL ".join(f"SELECT '{what}' AS what, {error} AS error" for what, error in _PROBLEMS.items()),
    "file_names",
    "file_1",
)
def _(t: Tables) -> DataFrame:
    """Broken snapshots and what is said of them, before anything is stored."""
    good = jobs.prices(t, 1)
    path, content = F.col("relative_path"), F.col("content")

    def ends(digit: int) -> Column:
        return path.endswith(f"{digit}.csv")

    header = F.encode(F.lit("Date\r\n"), "UTF-8")
    odd = F.concat(content, F.unhex(F.lit("FF0D0A")))
    renamed = F.when(ends(7), F.replace(path, F.lit(".csv"), F.lit(".CSV"))).otherwise(path)
    cases = {
        "changed header": lambda f: f.withColumn("content", F.when(ends(5), header).otherwise(content)),
        "not UTF-8": lambda f: f.withColumn("content", F.when(ends(6), odd).otherwise(content)),
        "stray files": lambda f: f.withColumn("relative_path", renamed),
        "too few": lambda f: f,
        "twice": lambda f: f.unionByName(f.filter(ends(8))),
        "none": lambda f: f.withColumn("relative_path", F.concat(F.lit("x/"), path)),
    }
    found = []
    for what, change in cases.items():
        expected = 1 if what == "too few" else None
        read = lambda change=change: change(good.read())
        try:
            prepare_prices(t.spark, jobs.STOCK, good.root, expected, manifest=good.manifest, read=read)
        except StructuralError as exc:
            found.append((what, str(exc)))
    return t.spark.createDataFrame(found, "what string, error string")


@query(
    "v4_raw_prices_only",
    "SELECT 'failed' AS status, TRUE AS says_adjusted, CAST(0 AS BIGINT) AS prices, count(*) AS files FROM file_1",
    "file_1",
)
def _(t: Tables) -> DataFrame:
    store = jobs.adjusted_load(t)
    return store.current("ingestion_runs", ["ingestion_run_id"]).select(
        "status",
        F.get_json_object("validation_summary", "$.error").contains("prices are adjusted").alias("says_adjusted"),
        F.lit(store.read("daily_prices").count()).cast("bigint").alias("prices"),
        F.lit(store.read("source_files").count()).cast("bigint").alias("files"),
    )


@query(
    "t5_error_examples",
    """SELECT 'conflicting duplicate keys, e.g. ' || string_agg(security_id || ', ' || trading_date, '; ' ORDER BY security_id, trading_date) AS error
    FROM (SELECT * FROM copy_groups WHERE conflict ORDER BY security_id, trading_date LIMIT 5) g HAVING count(*) > 0""",
    "copy_groups",
)
def _(t: Tables) -> DataFrame:
    found = []
    try:
        require_no_conflicts(copy_groups(t), ["security_id", "trading_date"])
    except ConflictingDuplicates as exc:
        found.append((str(exc),))
    return t.spark.createDataFrame(found, "error string")


cte("one_security", "SELECT k, count(reason) AS bad FROM edition_2 GROUP BY k", "edition_2")
_FROM, _TO = "1992-06-01", "1998-10-31"


def least_keys(judged: DataFrame) -> tuple[str | None, str | None]:
    """The least key without and with bad lines, from one pass over the lines."""
    key = F.col("source_key")
    return tuple(judged.agg(F.min(F.when(F.col("bad") == 0, key)), F.min(F.when(F.col("bad") > 0, key))).first())


@query(
    "v6_validated_read",
    f"""SELECT k AS security, trading_date, pos AS line, CAST(reference_price AS DOUBLE) + CASE WHEN changed THEN 1 ELSE 0 END AS reference_price,
      CAST(1 AS BIGINT) AS files, '' AS error FROM edition_2
      WHERE k = (SELECT min(k) FROM one_security WHERE bad = 0) AND trading_date BETWEEN DATE '{_FROM}' AND DATE '{_TO}'
    UNION ALL SELECT 'NONE', NULL, NULL, NULL, 0, 'UnknownSecurity'
    UNION ALL SELECT (SELECT min(k) FROM one_security WHERE bad > 0), NULL, NULL, NULL, 1, 'InvalidPrices'""",
    "edition_2",
    "one_security",
)
def _(t: Tables) -> DataFrame:
    """One security read from a folder of all; one that is not there; one with bad lines."""
    files = t.written("stock_edition_2", lambda: stock_edition(t, 2))
    provider = SnapshotPrices(t.spark, jobs.STOCK, folder(t, "stocks", files))
    judged = quarantine(jobs.STOCK.rows(files)).groupBy("source_key").agg(F.max(F.size("reasons")).alias("bad"))
    good, bad = least_keys(judged)
    name = jobs.STOCK.id_prefix
    rows = provider.daily_prices(_FROM, _TO, f"{name}{good}").select(
        F.lit(good).alias("security"),
        "trading_date",
        F.regexp_extract("raw_record_ref", "line=([0-9]+)$", 1).cast("bigint").alias("line"),
        F.col("reference_price").cast("double").alias("reference_price"),
        F.lit(provider.security_file(f"{name}{good}").count()).cast("bigint").alias("files"),
        F.lit("").alias("error"),
    )
    failed = []
    for key in ("NONE", bad):
        try:
            provider.daily_prices(_FROM, _TO, f"{name}{key}")
        except (UnknownSecurity, InvalidPrices) as exc:
            opened = 0 if isinstance(exc, UnknownSecurity) else provider.security_file(f"{name}{key}").count()
            failed.append((key, None, None, None, opened, type(exc).__name__))
    schema = "security string, trading_date date, line bigint, reference_price double, files bigint, error string"
    return rows.unionByName(t.spark.createDataFrame(failed, schema))


# ---------------------------------------------------------------------- sinks


def rebuilt(t: Tables) -> Store:
    """A store whose factors were written twice: the second build replaces the first."""

    def fill(store: Store) -> None:
        fresh = build(t)
        factors.write_build(store, fresh)
        factors.write_build(store, fresh)

    return jobs.once(t, "rebuild", fill)


@query(
    "k6_rebuild_factors",
    "SELECT factor_kind, status, count(*) AS n FROM all_factors GROUP BY factor_kind, status",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    rows = rebuilt(t).read("price_adjustment_factors")
    return rows.groupBy("factor_kind", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t4_sorted_factors",
    "SELECT factor_kind, count(*) AS rows, TRUE AS apart FROM all_factors GROUP BY factor_kind",
    "all_factors",
)
def _(t: Tables) -> DataFrame:
    """Bounds of the keys in each file of the sink: no two files overlap."""
    rows = rebuilt(t).read("price_adjustment_factors").withColumn("file", F.input_file_name())
    key = F.struct("security_id", "effective_date", "factor_kind")
    bounds = rows.groupBy("file").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    # One row a file.
    earlier = F.max("high").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.bool_and(F.coalesce(F.col("earlier") < F.col("low"), F.lit(True))), F.lit(True))
    # One row on the right.
    found = bounds.withColumn("earlier", earlier).agg(apart.alias("apart"))
    return rows.groupBy("factor_kind").agg(F.count(F.lit(1)).alias("rows")).join(F.broadcast(found), F.lit(True))
