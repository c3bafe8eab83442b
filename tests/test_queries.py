"""Registered queries against their check SQL on the smallest tables.

``python tests/oracle.py`` runs all of them at a larger scale.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "a11_anomaly_dates",
    "c1_derive_factors",
    "c3_adjusted_series",
    "w5_index_continuity",
    "c5_observed_trading_days",
    "a3_accepted_rows",
    "j1_upsert_classify",
    "v1_row_issues",
    "i11_to_i17_provenance",
    "p8_normalized_rows",
    "p12_event_records",
    "s4_snapshot_id",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_query_of_the_library_has_check_sql():
    from tickerloom.bindings import catalog

    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, name):
    con = duck(SF)
    problem = compare(
        spark, con, name, entry_points.queries()[name], entry_points.oracle_sql()[name], SF
    )
    assert problem in ("", "both empty")


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
