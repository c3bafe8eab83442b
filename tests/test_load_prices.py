"""Price snapshots: identity, parsing, quarantine, idempotent load."""

from __future__ import annotations

import hashlib
import json

import pytest
from market import (
    FRI,
    MON,
    PRICE_ID,
    REV,
    THU,
    TUE,
    WED,
    csv_line,
    few_stocks,
    line,
    packed,
    silent,
    stock_file,
    write_prices,
)

from tickerloom.plans.load_prices import dry_run, load_prices
from tickerloom.plans.registration import (
    LoadFailed,
    LoadNotConfirmed,
    prepare_prices,
    report_json,
)
from tickerloom.sources.adapters import STOCK_HEADER, StockCsvSource
from tickerloom.sources.snapshot import StructuralError, snapshot_files

SOURCE = StockCsvSource(PRICE_ID)
STOCKS = "dataset/stocks/csv"


def prepared(spark, root, **kw):
    return prepare_prices(spark, SOURCE, root, **kw)


def load(store, root, revision=REV):
    return load_prices(store, prepared(store.spark, root), confirm_revision=revision)


def incidents(store, kind=None):
    rows = store.read("data_quality_incidents").collect()
    return [r for r in rows if kind in (None, r.incident_type)]


def test_identity(spark, tmp_path):
    first = prepared(spark, write_prices(tmp_path / "a", few_stocks()))
    later = prepared(spark, write_prices(tmp_path / "b", few_stocks(), fetched="2021-07-01T00:00:00Z"))
    other = prepared(spark, write_prices(tmp_path / "c", few_stocks() | {"RIVR": [line("RIVR", FRI, 13)]}))
    assert first.snapshot_id == later.snapshot_id != other.snapshot_id
    assert first.snapshot_id == f"{PRICE_ID}:{REV}:{first.content_sha256[:16]}"


def test_content_hash_covers_every_file(spark, tmp_path):
    root = tmp_path / "s"
    write_prices(root, few_stocks())
    (root / "LICENSE").write_bytes(b"")
    listing = {
        f.relative_to(root).as_posix(): hashlib.sha256(f.read_bytes()).hexdigest()
        for f in root.rglob("*")
        if f.is_file() and f.name != "manifest.json"
    }
    p = prepared(spark, str(root))
    text = "".join(f"{n}\0{h}\n" for n, h in sorted(listing.items()))
    assert p.content_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert p.roles() == {"stock": 3, "index": 1, "preview": 1, "other": 2}
    assert snapshot_files(spark, str(root)).count() == len(listing)


@pytest.mark.parametrize("name", [".gitattributes", "_notes.csv", "_older/x.txt", "dataset/.cache/y.txt"])
def test_hidden_names_are_files_like_any_other(spark, tmp_path, name):
    root = write_prices(tmp_path / "s [1] {a}", few_stocks())
    before = {r.relative_path for r in snapshot_files(spark, root).collect()}
    path = tmp_path / "s [1] {a}" / name
    path.parent.mkdir(exist_ok=True)
    path.write_text("x")
    found = {r.relative_path: r for r in snapshot_files(spark, root).collect()}
    assert set(found) - before == {name} and found[name].size_bytes == 1
    assert found[name].sha256 == hashlib.sha256(b"x").hexdigest()
    assert prepared(spark, root).roles()["other"] == 2


@pytest.mark.parametrize(
    ("name", "content", "message"),
    [
        ("moon.csv", stock_file([line("MOON", MON, 1)]), "unexpected file"),
        ("MOON.csv.orig", b"-", "unexpected file"),
        ("RIVR.csv", b"Date,Ticker\r\n", "unexpected header"),
        ("DUNE.csv", stock_file([line("DUNE", MON, 1)]) + b"\x80\r\n", "not valid UTF-8"),
    ],
)
def test_structural_problems(spark, tmp_path, name, content, message):
    root = write_prices(tmp_path / "s", few_stocks())
    (tmp_path / "s" / STOCKS / name).write_bytes(content)
    with pytest.raises(StructuralError, match=message):
        prepared(spark, root)


def test_bytes_that_are_no_text_are_still_counted(spark, tmp_path):
    root = write_prices(tmp_path / "s", few_stocks(), indices={"OLD": b"Date\r\n\xff1\r\n2\r\n"})
    rows = {r.relative_path: r.row_count for r in prepared(spark, root).inventory.collect()}
    assert rows["dataset/indices/csv/OLD.csv"] == 2


def test_expectations(spark, tmp_path):
    root = write_prices(tmp_path / "s", few_stocks())
    with pytest.raises(StructuralError, match="expected 4 stock files, found 3"):
        prepared(spark, root, expect_stock_files=4)
    with pytest.raises(StructuralError, match="manifest is for"):
        prepare_prices(spark, StockCsvSource("elsewhere"), root)


def test_dry_run(store, tmp_path):
    p = prepared(store.spark, write_prices(tmp_path / "s", few_stocks()))
    report = dry_run(store, p)
    assert report_json(report) == report_json(dry_run(store, p))
    assert report["counters_consistent"] and store.read("daily_prices").isEmpty()
    assert (report["counters"]["rows_seen"], report["counters"]["rows_inserted"]) == (7, 7)
    seen = report["observations"]
    assert seen["status_counts"] == {"traded": 6, "no_regular_market_trade": 1, "unknown": 0}
    assert seen["flag_counts"] == {"non_regular_activity_present": 2, "unverified_trading_date": 1}
    assert seen["missing_open"] == 6


def test_load_twice(store, tmp_path):
    root = write_prices(tmp_path / "s", few_stocks())
    names = ("rows_seen", "rows_inserted", "rows_unchanged", "securities_created", "incidents_created")
    runs = [load(store, root)["counters"] for _ in range(2)]
    # the one incident: DUNE's ticker column says Dune
    assert [[c[n] for n in names] for c in runs] == [[7, 7, 0, 3, 1], [7, 0, 7, 0, 0]]
    keys = {r.source_key: r for r in store.read("security_source_keys").collect()}
    assert {k: r.security_id for k, r in keys.items()} == {"DUNE": 1, "MOON": 2, "RIVR": 3}
    assert keys["DUNE"].quality_flags == ["source_ticker_column_mismatch"]
    moon = store.read("daily_prices").filter("security_id = 2").orderBy("trading_date").collect()
    assert [(r.source_line, r.trading_status) for r in moon] == [
        (5, "no_regular_market_trade"), (4, "traded"), (3, "traded"), (2, "traded"),
    ]
    assert (moon[0].high, moon[0].low, moon[0].volume) == (None, None, 0)
    assert moon[0].quality_flags == ["non_regular_activity_present", "unverified_trading_date"]
    assert store.read("daily_prices").count() == 7
    done = store.current("ingestion_runs", ["ingestion_run_id"]).collect()
    assert [r.status for r in done] == ["succeeded"] * 2


def test_equal_numbers_in_another_notation(store, tmp_path):
    load(store, write_prices(tmp_path / "a", {"MOON": [line("MOON", FRI, "64")]}))
    again = {"MOON": [line("MOON", FRI, "64.00", Volume="1.2e3", Value=" 360000.0 ")]}
    c = load(store, write_prices(tmp_path / "b", again, revision="2" * 40), "2" * 40)["counters"]
    assert (c["rows_unchanged"], c["rows_conflicted"], c["rows_rejected"]) == (1, 0, 0)


def test_conflicts_keep_what_is_stored(store, tmp_path):
    load(store, write_prices(tmp_path / "a", few_stocks()))
    changed = few_stocks()
    changed["RIVR"][1] = line("RIVR", THU, "11.75")
    for revision in ("2" * 40, "3" * 40):
        root = write_prices(tmp_path / revision[0], changed, revision=revision)
        assert load(store, root, revision)["counters"]["rows_conflicted"] == 1
    [one] = incidents(store, "conflicting_observation")
    details = json.loads(one.details)
    assert (details["stored"]["close"], details["incoming"]["close"]) == ("11.5000", "11.7500")
    stored = store.read("daily_prices").filter(f"security_id = 3 AND trading_date = '{THU}'").first()
    assert float(stored.close) == 11.5


def test_names_follow_the_newest_row(store, tmp_path):
    names = []
    for k, (day, name) in enumerate([(WED, "Moon One"), (MON, "Moon Zero"), (THU, "Moon Two")]):
        root = write_prices(tmp_path / str(k), {"MOON": [line("MOON", day, 9, Name=name)]}, revision=str(k) * 40)
        load(store, root, str(k) * 40)
        names.append(store.current("securities", ["security_id"]).first().name)
    assert names == ["Moon One", "Moon One", "Moon Two"]


#: Each line's fault, the first line is good.
FAULTS = [
    (csv_line(line("MOON", FRI, 64)), None),
    (csv_line(line("MOON", THU, 63, Low=64)), "high_below_low"),
    (csv_line(line("MOON", WED, "6x3")), "High='6x3' is not a number"),
    (csv_line(line("MOON", "05/03/2019", 63)), "malformed date"),
    (csv_line(line("MOON", MON, 63, Volume="5.00000000001")), "Volume='5.00000000001' is not an integer"),
    (csv_line(line("MOON", "2019-02-24", 63, Volume="1e-11")), "Volume='1e-11' is not an integer"),
    (csv_line(line("MOON", "2019-03-01", "1e17")), "is out of range"),
    (csv_line(line("MOON", "2019-02-28", 63, "1e17")), "Previous='1e17' is out of range"),
    (csv_line(line("MOON", "2019-02-27", 63, Value="1e21")), "Value='1e21' is out of range"),
    (csv_line(line("MOON", "2019-02-26", 63, Volume="1e20")), "Volume='1e20' is out of range"),
    ("2019-02-25,MOON,x", "3 fields, expected 26"),
    ("", "0 fields, expected 26"),
]


def test_bad_rows_leave_the_good_ones(store, tmp_path):
    content = packed(STOCK_HEADER, [text for text, _ in FAULTS])
    c = load(store, write_prices(tmp_path / "s", {"MOON": content}))["counters"]
    bad = len(FAULTS) - 1
    assert (c["rows_seen"], c["rows_inserted"], c["rows_rejected"]) == (bad + 1, 1, bad)
    found = {i.source_line: i.details for i in incidents(store)}
    for number, (_, reason) in enumerate(FAULTS, 2):
        assert reason is None or reason in found[number], found[number]
    assert sorted(found) == list(range(3, len(FAULTS) + 2))


def test_equal_copies_become_one(store, tmp_path):
    copies = {"RIVR": [line("RIVR", FRI, 12), line("RIVR", FRI, "12.0"), line("RIVR", FRI, 12)]}
    c = load(store, write_prices(tmp_path / "s", copies))["counters"]
    assert (c["rows_inserted"], c["rows_collapsed_duplicates"]) == (1, 2)
    assert store.read("daily_prices").first().source_line == 2


def test_copies_that_differ_refuse_their_file(store, tmp_path):
    stocks = {
        "MOON": [line("MOON", FRI, 64), line("MOON", THU, 63), line("MOON", FRI, 65)],
        "RIVR": [line("RIVR", FRI, 12), line("RIVR", THU, 13, High=1)],
    }
    done = load(store, write_prices(tmp_path / "s", stocks))
    c = done["counters"]
    assert [c[n] for n in ("rows_seen", "rows_inserted", "rows_rejected", "files_failed")] == [5, 1, 4, 1]
    assert done["rejected_security_batches"] == ["MOON"]
    [twice] = incidents(store, "conflicting_duplicate_in_snapshot")
    assert f'"{FRI}":[2,4]' in twice.details
    assert len(incidents(store, "hard_invalid_record")) == 1


def test_quotes_and_lines_within_them(store, tmp_path):
    rows = [
        line("MOON", FRI, 64, Name='"Moon, ""Old"" Works"'),
        line("MOON", THU, 63, Name='"Moon\nWorks"'),
        line("MOON", WED, 62),
    ]
    load(store, write_prices(tmp_path / "s", {"MOON": packed(STOCK_HEADER, map(csv_line, rows))}))
    assert store.read("securities").first().name == 'Moon, "Old" Works'
    stored = {str(r.trading_date): r.source_line for r in store.read("daily_prices").collect()}
    assert stored == {FRI: 2, THU: 4, WED: 5}


def test_the_revision_has_to_be_named(store, tmp_path):
    p = prepared(store.spark, write_prices(tmp_path / "s", few_stocks()))
    for wrong in ("", REV[:-1], "9" * 40):
        with pytest.raises(LoadNotConfirmed):
            load_prices(store, p, confirm_revision=wrong)
    assert store.read("ingestion_runs").isEmpty()


def test_a_file_that_changes_on_the_way_fails_the_run(store, tmp_path):
    p = prepared(store.spark, write_prices(tmp_path / "s", few_stocks()))
    (tmp_path / "s" / STOCKS / "DUNE.csv").write_bytes(stock_file([silent("DUNE", TUE, 8, Ticker="Dune")]))
    with pytest.raises(LoadFailed, match="changed since"):
        load_prices(store, p, confirm_revision=REV)
    assert store.read("daily_prices").isEmpty() and store.read("securities").isEmpty()
    [run] = store.current("ingestion_runs", ["ingestion_run_id"]).collect()
    assert run.status == "failed"


def test_one_revision_with_two_contents(store, tmp_path):
    load(store, write_prices(tmp_path / "a", few_stocks()))
    load(store, write_prices(tmp_path / "b", few_stocks() | {"LAKE": [line("LAKE", FRI, 3)]}))
    assert len(incidents(store, "snapshot_content_mismatch")) == 1
