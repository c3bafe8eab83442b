"""Ordered scans against brute force, with one key holding most rows."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tickerloom.operators.ids import with_dense_ids
from tickerloom.operators.ordered import (
    asof_forward,
    by_chunks,
    numbered_with_lags,
    suffix_products,
    with_lags,
    with_row_number,
)
from tickerloom.plans.factors import match_events
from tickerloom.schemas import FactorMethod

START = date(2019, 12, 1)
CHUNK = 7  # small, so that most neighbours are in another chunk


def day(n):
    return START + timedelta(days=n)


@pytest.fixture(scope="module")
def rows():
    """(key, date, value): key 1 has half of all rows; gaps span many chunks."""
    rng = random.Random(5)
    out = []
    for key, size, span in ((1, 120, 400), (2, 40, 900), (3, 60, 60), (4, 1, 1), (5, 2, 700)):
        for n in rng.sample(range(span), size):
            out.append((key, day(n), rng.randint(1, 99)))
    return sorted(out)


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, d date, v int").repartition(3)


def test_lags_and_row_numbers(spark, rows):
    got = with_row_number(
        with_lags(
            frame(spark, rows), ["k"], "d", {"p1": ("v", 1), "p2": ("v", 2), "d1": ("d", 1)}, CHUNK
        ),
        ["k"],
        "d",
        "n",
        CHUNK,
    )
    want = set()
    for group in by_key(rows).values():
        for i, (k, d, v) in enumerate(group):
            p1 = group[i - 1][2] if i > 0 else None
            p2 = group[i - 2][2] if i > 1 else None
            d1 = group[i - 1][1] if i > 0 else None
            want.add((k, d, v, p1, p2, d1, i + 1))
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(rows)


def test_suffix_products_count_only_later_steps(spark, rows):
    rng = random.Random(6)
    steps = [(k, d, rng.choice((0.5, 2.0, 0.25)), v) for k, d, v in rows if rng.random() < 0.2]
    # A step on a date without a row still applies to earlier rows.
    steps += [(3, day(500), 4.0, 7), (9, day(3), 8.0, 1)]
    table = spark.createDataFrame(steps, "k int, d date, f double, paid int")
    got = suffix_products(frame(spark, rows), table, ["k"], "d", {"m": "f"}, ["paid"], CHUNK)
    want = {}
    for k, d, v in rows:
        product = 1.0
        for k2, d2, f, _ in steps:
            if k2 == k and d2 > d:
                product *= f
        paid = next((p for k2, d2, _, p in steps if (k2, d2) == (k, d)), None)
        want[k, d] = (v, product, paid)
    assert {(r.k, r.d): (r.v, r.m, r.paid) for r in got.collect()} == want


def test_forward_asof(spark, rows):
    rng = random.Random(7)
    left = [(rng.randint(1, 6), day(rng.randint(-20, 950)), i) for i in range(150)]
    got = asof_forward(
        spark.createDataFrame(left, "k int, at date, id int"),
        frame(spark, rows),
        ["k"],
        "at",
        "d",
        ["v"],
        days=CHUNK,
    )
    want = {}
    for k, at, i in left:
        later = [r for r in rows if r[0] == k and r[1] >= at]
        want[i] = (later[0][1], later[0][2]) if later else None
    assert {r.id: (r.hit.date, r.hit.v) if r.hit else None for r in got.collect()} == want


def test_event_match_is_the_nearest_event(spark):
    rng = random.Random(8)
    labels = {
        "stockSplit": "split",
        "reverseStock": "reverse_split",
        "hmetd": "rights",
        "sahamBonus": "bonus",
        "dividenSaham": "stock_dividend",
        "other": None,
    }
    breaks = sorted({(rng.choice((1, 1, 2)), day(rng.randint(0, 90))) for _ in range(60)})
    events = [
        (i, rng.choice((1, 1, 2, None)), day(rng.randint(-5, 130)), rng.choice(list(labels)))
        for i in range(120)
    ]
    got = match_events(
        spark.createDataFrame(breaks, "security_id int, trading_date date"),
        spark.createDataFrame(
            events, "event_id int, security_id int, registration_date date, source_category string"
        ),
        FactorMethod(),
    )
    want = {}
    for sid, d in breaks:
        found = []
        for i, s, at, category in events:
            gap = (at - d).days
            same_day = category in ("stockSplit", "reverseStock")
            if s != sid or labels[category] is None:
                continue
            if gap == 0 if same_day else 0 <= gap <= 28:
                found.append((gap, i, labels[category]))
        if found:
            want[sid, d] = min(found)[1:]
    assert {(r.security_id, r.trading_date): (r.event_id, r.label) for r in got.collect()} == want


def test_dense_ids_follow_key_order(spark):
    names = [f"K{n:03d}" for n in random.Random(9).sample(range(1000), 300)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    got = {r.name: r.id for r in with_dense_ids(df, "name", "id", 10).collect()}
    assert got == {n: 11 + i for i, n in enumerate(sorted(names))}


def test_large_side_is_shuffled_once_and_nothing_is_cross_joined(spark, rows):
    df = frame(spark, rows).withColumn("wide", F.lit("x"))
    plan = with_lags(df, ["k"], "d", {"p": ("v", 1)})._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(wide) == 4  # rows once; chunk tails, carry by key, carry back to chunks
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_numbered_with_lags_is_both_scans_in_one_shuffle(spark, rows):
    odd = [(6, None, 7), (None, day(3), 8), (None, day(30), 9)]
    df = spark.createDataFrame(rows + odd, "k int, d date, v int")
    chunked = by_chunks(df, ["k"], "d", CHUNK)
    lags = {"p1": ("v", 1), "p2": ("v", 2)}
    got = numbered_with_lags(chunked, ["k"], "d", "n", lags)
    want = with_lags(with_row_number(df, ["k"], "d", "n", CHUNK), ["k"], "d", lags, CHUNK)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Whole rows are dealt once; the second scan finds that shuffle again.
    assert "ReusedExchange" in plan or plan.split("Initial Plan")[0].count("REPARTITION_BY_NUM") == 1


def test_tables_are_dealt_to_tasks_by_their_rows(spark, monkeypatch):
    from tickerloom.operators import sizes

    monkeypatch.setattr(sizes, "TASK_ROWS", 10)
    df = spark.range(400).withColumn("k", F.col("id") % 50)
    assert sizes.in_tasks(df, "k").rdd.getNumPartitions() == 40
    assert sorted(r.id for r in sizes.in_tasks(df, "k").collect()) == list(range(400))


def test_bars_move_once_and_are_not_checkpointed(spark, monkeypatch):
    from tickerloom.bindings import derived
    from tickerloom.operators import sizes

    monkeypatch.setattr(sizes, "TASK_ROWS", 10)
    lines = spark.range(60).selectExpr(
        "id % 3 AS l_suppkey", "CAST(date_add(DATE'1995-01-01', CAST(id AS INT) * 40) AS TIMESTAMP) AS l_shipdate",
        "CAST(100 + id AS DOUBLE) AS l_extendedprice", "CAST(5 AS DOUBLE) AS l_quantity",
    )
    bars = derived.derive_bars(lines)
    assert bars.count() == 60
    assert "ExistingRDD" not in bars._jdf.queryExecution().executedPlan().toString()


def test_whole_histories_are_scanned_once_and_give_the_same_rows(spark, rows, monkeypatch):
    from tickerloom.operators import histories, sizes

    odd = [(6, None, 7), (6, day(9), 3), (None, day(3), 8), (None, day(30), 9), (None, day(900), 4)]
    df = spark.createDataFrame(rows + odd, "k int, d date, v int")
    steps = [(k, d, 2.0, v) for k, d, v in rows[::5]] + [(3, day(500), 4.0, 7), (None, day(40), 2.0, 1), (6, None, 2.0, 1)]
    table = spark.createDataFrame(steps, "k int, d date, f double, paid int")
    lags = {"p1": ("v", 1), "d2": ("d", 2)}

    def found(scans, numbered_rows):
        return [
            scans.with_lags(df, ["k"], "d", lags),
            scans.numbered_with_lags(numbered_rows, ["k"], "d", "n", lags),
            scans.suffix_products(df, table, ["k"], "d", {"m": "f"}, ["paid"]),
        ]

    def told(frames):
        return [sorted(map(str, f.collect())) for f in frames]

    from tickerloom.operators import ordered

    whole = found(histories, histories.dealt(df, ["k"], "d"))
    want = told(found(ordered, by_chunks(df, ["k"], "d")))
    assert told(whole) == want
    for f in whole:
        plan = f._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("REPARTITION_BY_NUM") == 1 and "Join" not in plan and "ENSURE_REQUIREMENTS" not in plan
    # A hot key: back to chunks.
    monkeypatch.setattr(sizes, "TASK_ROWS", 100)
    assert histories.dealt(df, ["k"], "d") is None
    assert told([histories.with_lags(df, ["k"], "d", lags)]) == want[:1]


def test_first_rows_are_found_without_sorting_prices(spark):
    from tickerloom.plans.factors import compared_by_date

    data = [(1, day(0), 1), (1, day(1), 1), (2, day(0), None), (2, day(1), 1), (3, day(1), 1), (4, None, 1), (4, day(1), 1)]
    prices = spark.createDataFrame(data, "security_id bigint, trading_date date, reference_price int")
    got = compared_by_date(prices)
    assert {r.trading_date: r.compared_securities for r in got.collect()} == {day(0): 0, day(1): 3, None: 0}
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_joins_and_asof_scans_have_tasks_for_their_rows(spark, rows, monkeypatch):
    from tickerloom.operators import sizes
    from tickerloom.operators.compare import key_difference
    from tickerloom.operators.upsert import classify

    monkeypatch.setattr(sizes, "TASK_ROWS", 10)
    df = frame(spark, rows)
    n = len(rows)
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // 10))
    some = df.filter("v % 2 = 0")
    gone = key_difference(df, some, ["k", "d"], rows=n)
    assert sorted((r.k, r.d) for r in gone.collect()) == [(k, d) for k, d, v in rows if v % 2]
    judged = classify(df, some.withColumn("v", F.when(F.col("v") > 50, 0).otherwise(F.col("v"))), ["k", "d"], ["v"], rows=n)
    assert {(r.k, r.d): r.outcome for r in judged.collect()} == {
        (k, d): "new" if v % 2 else "conflict" if v > 50 else "unchanged" for k, d, v in rows
    }
    left = spark.createDataFrame([(k, d) for k, d, _ in rows], "k int, at date")
    hits = asof_forward(left, df, ["k"], "at", "d", ["v"], days=CHUNK)
    for f, most in ((gone, n), (judged, n), (hits, 2 * n)):
        want = max(spark.sparkContext.defaultParallelism, -(-most // 10))
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert f", {want}), REPARTITION_BY_NUM" in plan
    assert tasks > spark.sparkContext.defaultParallelism
