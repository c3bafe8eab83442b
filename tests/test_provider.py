"""Reading a snapshot without loading it."""

from __future__ import annotations

import pytest
from market import FRI, MON, PRICE_ID, THU, WED, few_stocks, line, write_prices

from tickerloom.operators.dedupe import ConflictingDuplicates
from tickerloom.sources.adapters import StockCsvSource
from tickerloom.sources.provider import (
    InvalidPrices,
    NotProvided,
    SnapshotPrices,
    UnknownSecurity,
)


def provider(spark, root):
    return SnapshotPrices(spark, StockCsvSource(PRICE_ID), root)


def test_reading_by_security_and_range(spark, tmp_path):
    p = provider(spark, write_prices(tmp_path, few_stocks()))
    moon = f"dev:{PRICE_ID}:MOON"
    names = {r.ticker: (r.security_id, r.name) for r in p.list_securities().collect()}
    assert names["MOON"] == (moon, "Moon Works") and set(names) == {"MOON", "RIVR", "DUNE"}
    [one] = p.daily_prices(WED, WED, moon).collect()
    assert float(one.close) == 61 and one.open is None
    head, _, tail = one.raw_record_ref.partition("@sha256:")
    assert head == "dataset/stocks/csv/MOON.csv" and tail.endswith("#line=4")
    assert p.daily_prices("1999-01-01", "2029-01-01").count() == 7
    with pytest.raises(ValueError, match="after end"):
        p.daily_prices(FRI, MON)
    for unknown in (f"dev:{PRICE_ID}:LAKE", "MOON"):
        with pytest.raises(UnknownSecurity):
            p.daily_prices(MON, FRI, unknown)
    for missing in (p.dividends, p.corporate_actions, p.index_history):
        with pytest.raises(NotProvided):
            missing("MOON", MON, FRI)


def test_what_cannot_be_read_raises(spark, tmp_path):
    good = line("MOON", FRI, 64)

    def read(name, *rows):
        root = write_prices(tmp_path / name, {"MOON": list(rows)})
        return provider(spark, root).daily_prices(MON, FRI).count()

    assert read("copies", good, good, line("MOON", THU, 63)) == 2
    with pytest.raises(InvalidPrices, match="high_below_low"):
        read("range", good, line("MOON", THU, 63, Low=70))
    with pytest.raises(ConflictingDuplicates):
        read("conflict", good, line("MOON", FRI, 65))
    root = write_prices(tmp_path / "width", {"MOON": [good]})
    with (tmp_path / "width" / "dataset" / "stocks" / "csv" / "MOON.csv").open("ab") as file:
        file.write(b"2019-03-04\r\n")
    with pytest.raises(InvalidPrices, match="1 fields, expected 26"):
        provider(spark, root).strict_rows()
