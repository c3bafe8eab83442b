"""How derived files are gathered and how their lines are read."""

from __future__ import annotations


def test_files_are_gathered_in_tasks_of_few_lines(spark, monkeypatch):
    from tickerloom.bindings import files
    from tickerloom.operators import sizes

    monkeypatch.setattr(sizes, "TASK_ROWS", 10)
    lines = spark.range(400).selectExpr(
        "concat('f', id % 40) AS relative_path", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS trading_date",
        "CAST(id AS STRING) AS line",
    )
    made = files._as_files(lines, ("h",), "relative_path")
    assert made.rdd.getNumPartitions() == 40
    texts = {r.relative_path: bytes(r.content).decode("utf-8-sig") for r in made.collect()}
    assert texts == {
        f"f{k}": "\r\n".join(["h", *(str(n) for n in range(399, -1, -1) if n % 40 == k), ""]) for k in range(40)
    }


def test_lines_end_in_three_ways(spark):
    from tickerloom.sources.csv_lines import with_records

    texts = ["a,b\r\nc\rd\n", "", "\n", "x\n\r", "x\r\r\n", "\r\r", '"q""q, z",2\r\n3', '"",""""\n']
    files = spark.createDataFrame([(n, bytearray(t, "utf-8")) for n, t in enumerate(texts)], "n int, content binary")
    got = {r.n: [(x.line, list(x.cells)) for x in r.records] for r in with_records(files).collect()}
    assert got == {
        0: [(1, ["a", "b"]), (2, ["c"]), (3, ["d"])],
        1: [(1, [])],
        2: [(1, [])],
        3: [(1, ["x"]), (2, [])],
        4: [(1, ["x"]), (2, [])],
        5: [(1, []), (2, [])],
        6: [(1, ['q"q, z', "2"]), (2, ["3"])],
        7: [(1, ["", '"'])],
    }


def test_reasons_and_numbers_are_compiled(spark):
    from pyspark.sql import functions as F

    from tickerloom.functions.normalize import first_reason, number

    rows = spark.createDataFrame([("1.5",), ("\u00a02\u2003",), ("x",), (None,)], "t string")
    value = number(F.col("t"))
    found = rows.select("t", value.alias("v"), first_reason(F.when(value.isNull(), "bad"), F.when(value > 1.7, "big")).alias("r"))
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.v and float(r.v), r.r) for r in found.collect()] == [(1.5, []), (2.0, ["big"]), (None, ["bad"]), (None, ["bad"])]


def test_starts_of_records_are_those_of_whole_records(spark):
    from tickerloom.sources.csv_lines import with_heads, with_records

    texts = ["a,b,c\r\nd\r,e\n", "", "\n\nx", '"q""q, z",2,3,4\r\n3', '"",""""\n,"a"', 'a,"b\nc",d\n\n1,2,3', 'x"y,z']
    files = spark.createDataFrame(
        [(n, bytearray(t, "utf-8")) for n, t in enumerate(texts)] + [(7, bytearray(b"\xff")), (8, None)],
        "n int, content binary",
    )
    whole = {r.n: r.records for r in with_records(files).collect()}
    starts = {r.n: r for r in with_heads(files, 2).collect()}
    for n, records in whole.items():
        assert starts[n].header == (records and records[0].cells)
        heads = starts[n].heads and [tuple(h) for h in starts[n].heads]
        assert heads == (records and [(r.line, len(r.cells), r.cells[:2]) for r in records])
    assert whole[5] and starts[7].heads is None and starts[8].header is None


def test_a_file_is_inspected_without_its_other_cells(spark):
    from tickerloom.sources.adapters import STOCK_HEADER, StockCsvSource

    def line(*cells):
        return ",".join([*cells, *["0"] * (len(STOCK_HEADER) - len(cells))])

    lines = [
        ",".join(STOCK_HEADER), line("2024-02-30", "ABC", "no such day"), line("2024-01-03T00:00:00", "abc", '" Two, ""b"" "'),
        line("2024-01-03", "Abc", "later line"), "2024-01-09,ABC,short", line("2024-01-02", " abc ", "One"),
    ]
    path = "dataset/stocks/csv/ABC.csv"
    content = bytearray("\r\n".join(lines), "utf-8")
    files = spark.createDataFrame([(path, "s", 1, content)] * 2, "relative_path string, sha256 string, size_bytes long, content binary")
    inspected = StockCsvSource("x").inspected(files)
    first, second = inspected.collect()
    assert first == second and (first.row_count, first.problem, first.newest_name) == (5, None, 'Two, "b"')
    assert (str(first.newest_date), first.ticker_mismatch_values) == ("2024-01-03", ["Abc", "abc"])
    assert "records#" not in inspected._jdf.queryExecution().analyzed().toString()


def test_findings_are_listed_for_bad_rows_only(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from tickerloom.functions.validate import hard_codes, hard_price_codes, price_issues

    prices = [None, Decimal(-1), Decimal(1), Decimal(2)]
    rows = spark.createDataFrame(
        [(o, h, c, v, s) for o in prices for h in prices for c in prices for v in (None, -1, 1) for s in (None, "traded", "unknown")],
        "open decimal(20,4), high decimal(20,4), close decimal(20,4), volume long, trading_status string",
    ).withColumn("low", F.col("open"))
    pairs = rows.select(hard_codes(price_issues()).alias("a"), hard_price_codes().alias("b")).collect()
    assert all(r.a == r.b for r in pairs) and {len(r.b) for r in pairs} > {0, 1}


def test_records_are_parsed_once_for_all_their_values(spark):
    from tickerloom.sources import json_records

    record = '{"id":1,"KodeEmiten":"5","TanggalPencatatan":"2024-01-02T00:00:00","JenisTindakan":"x","JumlahSaham":3,"JumlahSahamSetelahTindakan":"4"}'
    text = '{"totalRecordsAllTypes":2,"categories":{"c":{"count":2,"data":[' + record + "," + record.replace('"5"', "5") + "]}}}"
    files = spark.createDataFrame([("f", "s", bytearray(text, "utf-8"))], "relative_path string, sha256 string, content binary")
    found = json_records.action_records(files)
    assert [(r.source_ticker, int(r.shares_after), r.reasons) for r in found.collect()] == [("5", 4, []), (None, 4, ["empty ticker"])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1 and plan.count("decimal(38,10)") == 4
    paid = '{"A.JK":[{"dividend":"1.5","dividend_type":"final","ex_date":"2024-01-02","fiscal_year":"2024","payment_date":null}]}'
    files = spark.createDataFrame([("f", "s", bytearray(paid, "utf-8"))], "relative_path string, sha256 string, content binary")
    found = json_records.dividend_records(files)
    assert [(str(r.ex_date), r.reasons) for r in found.collect()] == [("2024-01-02", [])]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1


def test_keys_are_found_in_one_pass(spark):
    from pyspark.sql import functions as F

    from tickerloom.bindings.structure_queries import least_keys

    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def looked(n):
        seen.add(1)
        return n

    lines = spark.createDataFrame([("b", 0), ("a", 2), ("c", 0), ("d", 1)], "source_key string, n int")
    judged = lines.groupBy("source_key").agg(F.max(looked("n")).alias("bad"))
    assert least_keys(judged) == ("b", "a") and seen.value == 4
    assert least_keys(judged.filter("bad > 5")) == (None, None)
