"""Publications: all tables appear together or not at all, and nothing is lost to another writer."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickerloom.plans import folders
from tickerloom.plans.registration import staging
from tickerloom.plans.store import ConcurrentPublication

SCOPE = {"price_source_id": "s", "method_version": "m"}


def dates(store, *days):
    rows = [(d, 1) for d in days]
    found = store.spark.createDataFrame(rows, "d string, n bigint")
    return found.select(F.to_date("d").alias("trading_date"), F.col("n").alias("mismatched_securities"))


def security(number):
    return {"security_id": number, "ticker": f"T{number}", "version": number}


def anomalies(store):
    return sorted(str(r.trading_date) for r in store.read("reference_price_anomaly_dates").collect())


def test_tables_appear_together(store):
    with store.begin() as publication:
        publication.append_rows("securities", [security(1), security(2)])
        publication.append_rows("data_sources", [{"source_id": "a"}])
        assert publication.written("securities").count() == 2
        assert store.read("securities").isEmpty() and store.read("data_sources").isEmpty()
    assert (store.read("securities").count(), store.read("data_sources").count()) == (2, 1)
    assert [r.ticker for r in store.current("securities", ["security_id"]).orderBy("ticker").collect()] == ["T1", "T2"]


def test_a_failure_on_the_way_leaves_nothing(store):
    store.append_rows("securities", [security(1)])
    with pytest.raises(KeyError), store.begin() as publication:
        publication.append_rows("securities", [security(2)])
        raise KeyError("crash")
    assert store.read("securities").count() == 1 and store.vacuum() == []


def test_a_writer_that_dies_is_not_seen(store):
    store.append_rows("securities", [security(1)])
    lost = store.begin()
    lost.append_rows("securities", [security(2)])
    assert store.read("securities").count() == 1
    [gone] = store.vacuum()
    assert gone.startswith("securities/load=") and store.read("securities").count() == 1


def test_decisions_that_became_stale_are_refused(store):
    first, second, other = store.begin(), store.begin(), store.begin()
    first.append_rows("securities", [security(1)])
    first.publish(unchanged=["securities"])
    other.append_rows("data_sources", [{"source_id": "a"}])
    other.publish(unchanged=["data_sources"])
    second.append_rows("securities", [security(1)])
    with pytest.raises(ConcurrentPublication, match="securities"):
        second.publish(unchanged=["securities"])
    assert store.read("securities").count() == 1 and store.read("data_sources").count() == 1
    assert store.vacuum() == []


def test_a_number_is_taken_once(store):
    store.append_rows("data_sources", [{"source_id": "a"}])
    now = store.manifest()
    assert now.number == 1 and not store.put(now)
    late, early = store.begin(), store.begin()
    early.append_rows("data_sources", [{"source_id": "b"}])
    late.append_rows("data_sources", [{"source_id": "c"}])
    early.publish()
    late.publish()
    assert sorted(r.source_id for r in store.read("data_sources").collect()) == ["a", "b", "c"]


def test_scopes_are_replaced_while_they_are_read(store):
    table = "reference_price_anomaly_dates"
    store.replace_scope(table, dates(store, "2020-01-01", "2020-01-02"), SCOPE)
    store.replace_scope(table, dates(store, "2021-01-01"), SCOPE | {"method_version": "n"})
    before = store.read(table)
    mine = before.filter("method_version = 'm' AND trading_date > '2020-01-01'")
    store.replace_scope(table, mine, SCOPE)
    assert anomalies(store) == ["2020-01-02", "2021-01-01"]
    assert before.count() == 3  # the old folders are still there for who began with them
    store.replace_scope(table, dates(store, "2020-01-01").limit(0), SCOPE)
    assert anomalies(store) == ["2021-01-01"]
    assert len(store.vacuum()) == 2 and anomalies(store) == ["2021-01-01"]


def test_staging_is_removed(store):
    for fails in (False, True):
        try:
            with staging(store, "trial") as stage_id:
                assert store.stage(stage_id, "x", store.spark.range(3)).count() == 3
                if fails:
                    raise KeyError("crash")
        except KeyError:
            pass
    assert folders.names(store.spark, f"{store.root}/_staging") == []
