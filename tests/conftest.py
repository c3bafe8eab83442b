from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    s = session("8")
    s.conf.set("spark.sql.shuffle.partitions", "2")
    yield s
    s.stop()


@pytest.fixture
def store(spark, tmp_path):
    from tickerloom.plans.store import Store

    return Store(spark, str(tmp_path / "store"))
