"""Source files derived from the tables: CSV and JSON text for the readers.

A stock or index file holds one year of one security or index, so it has at most
366 lines; a JSON document holds a block of 1000 consecutive order keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.bindings.derived import Tables
from tickerloom.operators.sizes import in_tasks
from tickerloom.sources.adapters import INDEX_HEADER, STOCK_HEADER

BLOCK = 1000


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("0.0"))


def _as_files(lines: DataFrame, header: tuple[str, ...], path: str) -> DataFrame:
    """Lines ``(relative_path, trading_date, line)`` as files, newest date first.

    Lines are dealt to tasks small enough to gather them in memory.
    """
    body = F.transform(
        F.sort_array(F.collect_list(F.struct("trading_date", "line")), asc=False),
        lambda x: x["line"],
    )
    text = F.concat(
        F.lit("﻿" + ",".join(header) + "\r\n"), F.array_join("body", "\r\n"), F.lit("\r\n")
    )
    content = F.encode("text", "UTF-8")
    return (
        in_tasks(lines, path)
        .groupBy(path)
        .agg(body.alias("body"))
        .select(path, text.alias("text"))
        .select(
            path,
            F.sha2(content, 256).alias("sha256"),
            F.octet_length(content).alias("size_bytes"),
            content.alias("content"),
        )
    )


def stock_key(year: Column) -> Column:
    return F.concat(F.lit("S"), F.col("security_id").cast("string"), F.lit("Y"), year.cast("string"))


def _stock_lines(bars: DataFrame) -> DataFrame:
    """Bars as lines the way a source publishes them, with planted bad ones."""
    rn, sid = F.col("rn"), F.col("security_id")
    key = stock_key(F.year("trading_date"))
    day = F.col("trading_date").cast("string")
    cells = {
        "Date": F.when(rn % 97 == 0, F.replace(day, F.lit("-"), F.lit("/")))
        .when(rn % 4 == 0, F.concat(day, F.lit("T00:00:00")))
        .otherwise(day),
        "Ticker": F.when(sid % 6 == 0, F.lower(key)).otherwise(key),
        "Name": F.when(
            sid % 4 == 0,
            F.concat(
                F.lit('"Company '), sid.cast("string"), F.lit(', ""Y'), rn.cast("string"), F.lit('"""')
            ),
        ).otherwise(F.concat(F.lit("Company "), sid.cast("string"), F.lit(" Y"), rn.cast("string"))),
        "Previous": _text("reference_price"),
        "Open": _text("open"),
        "High": _text("high"),
        "Low": _text("low"),
        "Close": F.when(rn % 89 == 0, "n/a").otherwise(_text("close")),
        "Volume": F.concat(F.col("volume").cast("string"), F.lit(".0")),
        "Value": _text("value"),
        "Frequency": F.col("frequency").cast("string"),
        "NonRegularVolume": F.when(
            F.array_contains("quality_flags", "non_regular_activity_present"), "5"
        ).otherwise("0"),
    }
    full = F.concat_ws(",", *[cells.get(h, F.lit("0")) for h in STOCK_HEADER])
    line = F.when(rn % 83 == 0, F.concat(day, F.lit(",short"))).otherwise(full)
    path = F.concat(F.lit("dataset/stocks/csv/"), key, F.lit(".csv"))
    return bars.select(path.alias("relative_path"), "trading_date", line.alias("line"))


def _stock_files(t: Tables) -> DataFrame:
    return _as_files(_stock_lines(t.numbered_bars), STOCK_HEADER, "relative_path")


def stock_edition(t: Tables, edition: int) -> DataFrame:
    """Two snapshots of the same securities.

    The first lacks every tenth row; one file in ten repeats its last line, and one in 23
    has that line once more with another flag. The second is whole, without copies, and
    prints another reference price on some rows.
    """
    rn, sid = F.col("rn"), F.col("security_id")
    bars = t.numbered_bars
    if edition == 1:
        bars = bars.filter(rn % 10 != 9)
    else:
        other = (F.col("reference_price") + 1).cast("decimal(20,4)")
        changed = F.when((sid + rn) % 37 == 0, other).otherwise(F.col("reference_price"))
        bars = bars.withColumn("reference_price", changed)
    files = _as_files(_stock_lines(bars), STOCK_HEADER, "relative_path")
    if edition != 1:
        return files
    named = F.regexp_extract("relative_path", r"S(\d+)Y(\d+)\.csv$", 1).cast("bigint") + F.regexp_extract(
        "relative_path", r"Y(\d+)\.csv$", 1
    ).cast("bigint")
    text = F.col("content").cast("string")
    last = F.element_at(F.split(text, "\r\n"), -2)
    flipped = F.when(last.endswith(",5,0,0"), F.regexp_replace(last, ",5,0,0$", ",0,0,0")).otherwise(
        F.regexp_replace(last, ",0,0,0$", ",5,0,0")
    )
    extra = F.concat(
        F.when(named % 10 == 0, F.concat(last, F.lit("\r\n"))).otherwise(""),
        F.when(named % 23 == 0, F.concat(flipped, F.lit("\r\n"))).otherwise(""),
    )
    content = F.encode(F.concat(text, extra), "UTF-8")
    return files.select("relative_path", content.alias("content")).select(
        "relative_path",
        F.sha2("content", 256).alias("sha256"),
        F.octet_length("content").alias("size_bytes"),
        "content",
    )


def _index_files(t: Tables) -> DataFrame:
    """Index values as yearly files; some rows contradict themselves."""
    rn = F.col("source_line") - 1
    close, previous = F.col("close"), F.col("previous")
    change = (close - previous) + F.when(rn % 31 == 0, 1).otherwise(0)
    cells = {
        "Date": F.when(rn % 41 == 0, F.date_format("trading_date", "yyyy-M-dd")).otherwise(
            F.col("trading_date").cast("string")
        ),
        "Previous": previous.cast("string"),
        "Highest": F.when(rn % 37 == 0, (close - 1).cast("string")).otherwise(
            F.col("high").cast("string")
        ),
        "Lowest": F.col("low").cast("string"),
        "Close": close.cast("string"),
        "Constituent": F.when(rn % 43 == 0, "9.5").otherwise("900"),
        "Change": change.cast("string"),
    }
    line = F.concat_ws(",", *[cells.get(h, F.lit("7")) for h in INDEX_HEADER])
    path = F.concat(
        F.lit("dataset/indices/csv/"),
        F.replace("index_code", F.lit(" "), F.lit("-")),
        F.lit("-"),
        F.year("trading_date").cast("string"),
        F.lit(".csv"),
    )
    return _as_files(
        t.index_values.select(path.alias("relative_path"), "trading_date", line.alias("line")),
        INDEX_HEADER,
        "relative_path",
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _json_files(entries: DataFrame, name: str, wrap: Column) -> DataFrame:
    content = F.encode(wrap, "UTF-8")
    return entries.select(
        F.concat(F.lit("block-"), F.col("block").cast("string"), F.lit(f"/{name}")).alias(
            "relative_path"
        ),
        F.sha2(content, 256).alias("sha256"),
        content.alias("content"),
    )


def _event_record(after: Column) -> Column:
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate").cast("string")
    return F.concat(
        F.lit('{"id":'),
        key.cast("string"),
        F.lit(',"KodeEmiten":'),
        F.when(key % 17 == 0, F.col("o_custkey").cast("string")).otherwise(
            _quoted(F.concat(F.lit(" s"), (F.col("o_custkey") % 100).cast("string")))
        ),
        F.lit(',"TanggalPencatatan":'),
        _quoted(F.concat(day, F.when(key % 13 == 0, "T10:00:00").otherwise("T00:00:00"))),
        F.lit(',"JenisTindakan":"x"'),
        F.when(key % 19 == 0, "").otherwise(
            F.concat(
                F.lit(',"JumlahSaham":'),
                F.when(key % 5 == 0, "null").otherwise((key % 900 - F.when(key % 23 == 0, 1000).otherwise(0)).cast("string")),
            )
        ),
        F.lit(',"JumlahSahamSetelahTindakan":"'),
        after,
        F.lit('"}'),
    )


def _event_documents(orders: DataFrame) -> DataFrame:
    """Event records in ``r`` as documents of a block each, grouped by priority as category."""
    records = orders.select(
        F.floor(F.col("o_orderkey") / BLOCK).alias("block"),
        F.col("o_orderpriority").alias("category"),
        F.struct(F.col("o_orderkey").alias("k"), "r").alias("s"),
    )
    categories = records.groupBy("block", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list("s")), lambda x: x["r"]), ","
        ).alias("data"),
    )
    body = F.concat(
        _quoted(F.col("category")), F.lit(':{"count":'), F.col("n").cast("string"), F.lit(',"data":['), F.col("data"), F.lit("]}")
    )
    docs = categories.groupBy("block").agg(
        F.sum("n").alias("total"), F.array_join(F.array_sort(F.collect_list(body)), ",").alias("c")
    )
    wrap = F.concat(
        F.lit('{"totalRecordsAllTypes":'), F.col("total").cast("string"), F.lit(',"categories":{'), F.col("c"), F.lit("}}")
    )
    return _json_files(docs, "corporateActions.json", wrap)


def _event_files(t: Tables) -> DataFrame:
    return _event_documents(t.table("orders").withColumn("r", _event_record(F.lit("12.5"))))


def event_edition(t: Tables, edition: int) -> DataFrame:
    """Two snapshots of the same events.

    The first lacks every tenth event; some are given twice, some with another share count.
    The second is whole, without copies, and has other counts on some events.
    """
    key, orders = F.col("o_orderkey"), t.table("orders")
    if edition != 1:
        return _event_documents(orders.withColumn("r", _event_record(F.when(key % 7 == 0, "14.5").otherwise("12.5"))))
    first = orders.filter(key % 10 != 9)
    plain = first.withColumn("r", _event_record(F.lit("12.5")))
    other = first.filter(key % 90 == 0).withColumn("r", _event_record(F.lit("13.5")))
    return _event_documents(plain.unionByName(plain.filter(key % 40 == 0)).unionByName(other))


def _dividend_files(t: Tables) -> DataFrame:
    """Orders as dividend records, grouped by ticker."""
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    record = F.concat(
        F.lit('{"dividend":'),
        _quoted(F.when(key % 11 == 0, F.concat(F.lit("-"), amount)).otherwise(amount)),
        F.lit(',"dividend_type":'),
        F.when(key % 29 == 0, '""').otherwise('"final"'),
        F.lit(',"ex_date":'),
        _quoted(
            F.when(key % 13 == 0, F.date_format(day, "yyyy-M-dd")).otherwise(day.cast("string"))
        ),
        F.lit(',"fiscal_year":'),
        F.when(key % 17 == 0, "19").otherwise(_quoted(F.year(day).cast("string"))),
        F.lit(',"payment_date":'),
        F.when(key % 3 == 0, "null")
        .when(key % 7 == 0, _quoted(F.date_format(day, "yyyy-MM-d'x'")))
        .otherwise(_quoted(day.cast("string"))),
        F.lit("}"),
    )
    ticker = F.concat(F.lit("S"), (F.col("o_custkey") % 100).cast("string"), F.lit(".JK"))
    records = t.table("orders").select(
        F.floor(key / BLOCK).alias("block"),
        ticker.alias("ticker"),
        F.struct(key.alias("k"), record.alias("r")).alias("s"),
    )
    lists = records.groupBy("block", "ticker").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("s")), lambda x: x["r"]), ","
        ).alias("data")
    )
    body = F.concat(_quoted(F.col("ticker")), F.lit(":["), F.col("data"), F.lit("]"))
    docs = lists.groupBy("block").agg(
        F.array_join(F.array_sort(F.collect_list(body)), ",").alias("c")
    )
    return _json_files(docs, "all_dividends.json", F.concat(F.lit("{"), F.col("c"), F.lit("}")))


def stock_files(t: Tables) -> DataFrame:
    return t.written("stock_files", lambda: _stock_files(t))


def index_files(t: Tables) -> DataFrame:
    return t.written("index_files", lambda: _index_files(t))


def event_files(t: Tables) -> DataFrame:
    return t.written("event_files", lambda: _event_files(t))


def dividend_files(t: Tables) -> DataFrame:
    return t.written("dividend_files", lambda: _dividend_files(t))
