"""Groups of equal keys against a plain recomputation."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import dedupe, ordered, sizes


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_groups(spark, monkeypatch, few):
    monkeypatch.setattr(sizes.checked, "__defaults__", (few,))
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(400)]), rng.randint(0, 9), rng.choice([None, 1, 2]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k bigint, j bigint, v bigint, line bigint").repartition(3)
    groups = dedupe.key_groups(df, ["k", "j"], ["v"], F.col("line"), ["line", "v"])
    by_key = defaultdict(list)
    for k, j, v, line in rows:
        by_key[k, j].append((line, v))
    want = {(*k, len(c), len({v for _, v in c}) > 1, *min(c)) for k, c in by_key.items()}
    assert {tuple(r) for r in groups.collect()} == want and any(len(c) > 2 for c in by_key.values())
    assert dedupe.accepted(groups, ["k"]).count() < len(want)


def test_unique_rows_are_not_shuffled(spark):
    df = spark.range(1000).withColumn("line", F.col("id"))
    groups = dedupe.key_groups(df, ["id"], ["line"], F.col("line"), ["line"])
    # The branch of the unique rows is a scan and a broadcast join.
    single = groups._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "Aggregate" not in single and groups.filter("copies > 1").isEmpty()


def test_sparse_asof_reads_what_is_asked_for(spark):
    days = "date_add(DATE '2000-01-01', CAST(id AS INT))"
    right = spark.range(6000).selectExpr("id % 7 AS k", f"{days} AS d", "id AS v")
    left = spark.createDataFrame([(3, "2009-05-05"), (3, "2030-01-01"), (9, "2000-01-01"), (5, "2016-06-03")], "k bigint, t string")
    left = left.select("k", F.to_date("t").alias("t"))
    got = {(r.k, str(r.t)): r.hit and (str(r.hit.date), r.hit.v) for r in
           ordered.asof_forward(left, right, ["k"], "t", "d", ["v"]).collect()}
    table = right.collect()
    for (k, t), hit in got.items():
        later = min(((str(r.d), r.v) for r in table if r.k == k and str(r.d) >= t), default=None)
        assert hit == later
    assert got[3, "2009-05-05"] and got[9, "2000-01-01"] is None
