"""Run queries on Spark and their check SQL on DuckDB and compare the rows.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return repr(v + 0.0) if v == v else "nan"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def compare(spark, con, name, fn, sql, sf_dir) -> str:
    """Empty text when both engines agree, otherwise the first differences."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if sum(got.values()) else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "date": "DATE",
        "boolean": "BOOLEAN",
    }
    duck_types = {d[0]: str(d[1]) for d in con.execute(sql).description}
    for column, kind in df.dtypes:
        expected = types[kind]
        if duck_types[column].upper() != expected and not (
            expected == "VARCHAR" and duck_types[column].upper() == "STRING"
        ):
            return f"type of {column}: spark {kind}, duckdb {duck_types[column]}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; only spark "
            f"{sum(extra.values())}: {list(extra)[:2]}; only sql {sum(missing.values())}: "
            f"{list(missing)[:2]}"
        )
    return "" if got else "both empty"


def session(cpus: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tickerloom-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark, con, bad = session(), duck(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            problem = compare(
                spark, con, name, e.queries()[name], e.oracle_sql().get(name), sf_dir
            )
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem not in ("", "both empty")
        kind = "sql" if name in e.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - t:6.2f}s {kind} {name} {problem}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
