"""Snapshot folders of an invented market week, written by a rule.

Twenty plain securities close at ``200 + 10 i`` on Monday and one higher each day. Six
more have one story each, told by their closes and the references printed with them.
"""

from __future__ import annotations

import json
from pathlib import Path

from tickerloom.sources.adapters import INDEX_HEADER, STOCK_HEADER

PRICE_ID, EVENT_ID, DIVIDEND_ID = "week-csv", "week-events", "week-dividends"
REV, EVENT_REV, DIVIDEND_REV = (c * 40 for c in "1ce")
FETCHED = "2020-02-29T06:00:00Z"
MON, TUE, WED, THU, FRI = WEEK = [f"2019-03-{d:02d}" for d in range(4, 9)]


def line(key: str, day: str, close, reference=None, **cells) -> dict[str, str]:
    """A traded row of a security; `reference` is the close unless it is given."""
    out = dict.fromkeys(STOCK_HEADER, "0")
    reference = close if reference is None else reference
    out |= {"Date": day, "Ticker": key, "Name": f"{key.title()} Works", "Remarks": "-"}
    out |= {"Close": str(close), "High": str(close), "Low": str(close), "Previous": str(reference)}
    out |= {"Volume": "1200", "Value": "360000", "Frequency": "7"}
    return out | {k: str(v) for k, v in cells.items()}


def silent(key: str, day: str, close, **cells) -> dict[str, str]:
    """A row of a day without a trade."""
    none = dict.fromkeys(("High", "Low", "Volume", "Value", "Frequency"), "0")
    return line(key, day, close, **(none | cells))


def packed(header, lines) -> bytes:
    return ("﻿" + "".join(f"{x}\r\n" for x in [",".join(header), *lines])).encode()


def csv_line(cells: dict[str, str]) -> str:
    return ",".join(cells[c] for c in STOCK_HEADER)


def stock_file(rows) -> bytes:
    return packed(STOCK_HEADER, map(csv_line, rows))


def index_line(day: str, previous: float, close: float, change=None) -> str:
    """High and low lie 5 outside of both values."""
    change = close - previous if change is None else change
    high, low = max(previous, close) + 5, min(previous, close) - 5
    return f"{day},{previous},{high},{low},{close},40,{change},9000,81000,60,700000"


def manifest(root: Path, source_id: str, revision: str, fetched: str = FETCHED) -> None:
    root.mkdir(parents=True, exist_ok=True)
    facts = {"source_id": source_id, "revision": revision, "retrieved_at": fetched}
    facts |= {"source_url": "https://week.invalid", "archive_sha256": "d" * 64}
    facts |= {"licence": "none", "licence_read_on": "2020-02-28"}
    (root / "manifest.json").write_text(json.dumps(facts))


def write_prices(root: Path, stocks, revision=REV, fetched=FETCHED, indices=None) -> str:
    """`stocks` and `indices` by name: rows, or the bytes of a file."""
    manifest(root, PRICE_ID, revision, fetched)
    files = {f"stocks/csv/{k}.csv": v if isinstance(v, bytes) else stock_file(v) for k, v in stocks.items()}
    indices = {"WEEKLY": [index_line(MON, 100, 101)]} if indices is None else indices
    files |= {f"indices/csv/{k}.csv": v if isinstance(v, bytes) else packed(INDEX_HEADER, v) for k, v in indices.items()}
    files["preview/stocks/csv/SHOW.csv"] = stock_file([line("SHOW", MON, 1)])
    for name, content in files.items():
        path = root / "dataset" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    (root / "metadata.json").write_text('{"week": 10}')
    return str(root)


def few_stocks():
    """Seven rows: MOON has four of them, one a Saturday without a trade; DUNE's ticker differs by case."""
    return {
        "MOON": [
            line("MOON", FRI, 64),
            line("MOON", THU, 63, Open=62, High=63, Low=61),
            line("MOON", WED, 61, NonRegularVolume=5),
            silent("MOON", "2019-03-02", 60, NonRegularVolume=9),
        ],
        "RIVR": [line("RIVR", FRI, 12), line("RIVR", THU, "11.5")],
        "DUNE": [line("DUNE", FRI, 8, Ticker="Dune")],
    }


#: Closes from Monday on, and the references that are not the close before.
STORIES = {
    "CUTS": ((800, 204, 208, 205, 210), {TUE: 200}),  # four for one
    "HALF": ((600, 610, 306, 307, 308), {WED: 305}),  # two for one, on the odd day
    "BONS": ((360, 370, 375, 303, 306), {THU: 300}),  # bonus shares, registered later
    "ODDS": ((97, 98, 99, 100, 91), {FRI: 90}),  # no event explains it
    "PAYS": ((500, 500, 475, 480, 480), {}),  # 25 paid on Wednesday
    "LATE": ((150, 150, 144, 145, 146), {}),  # 6 due on Tuesday, when it does not trade
}


def week():
    """26 securities; on Wednesday three references are off, two of them without a reason."""
    stories = {f"PL{i:02d}": (tuple(200 + 10 * i + d for d in range(5)), {}) for i in range(20)}
    for i in (3, 4):
        stories[f"PL{i:02d}"][1][WED] = 150
    stocks = {}
    for key, (closes, odd) in (stories | STORIES).items():
        rows = [
            line(key, day, closes[d], odd.get(day, closes[max(0, d - 1)]))
            for d, day in enumerate(WEEK)
        ]
        if key == "LATE":
            rows[1] = silent(key, TUE, 150)
        stocks[key] = rows[::-1]
    return stocks


def event(number: int, key, day: str, label: str, before=200, after=800) -> dict:
    return {
        "id": number,
        "KodeEmiten": key,
        "TanggalPencatatan": f"{day}T00:00:00",
        "JenisTindakan": label,
        "JumlahSaham": before,
        "JumlahSahamSetelahTindakan": after,
    }


def week_events():
    return {
        "sahamBonus": [event(21, "BONS", "2019-03-20", "sahamBonus")],
        "stockSplit": [event(22, " half", WED, "stockSplit"), event(23, "CUTS", TUE, "stockSplit")],
        "hmetd": [event(24, "ODDS", "2019-04-17", "hmetd"), event(25, "GONE", TUE, "hmetd")],
        "reverseStock": [event(26, "PL07", "2018-12-03", "reverseStock")],
    }


def event_doc(categories) -> dict:
    blocks = {name: {"count": len(rows), "data": rows} for name, rows in categories.items()}
    return {"categories": blocks, "totalRecordsAllTypes": sum(map(len, categories.values()))}


def write_events(root: Path, doc=None, revision=EVENT_REV) -> str:
    manifest(root, EVENT_ID, revision)
    (root / "data").mkdir(exist_ok=True)
    text = json.dumps(event_doc(week_events()) if doc is None else doc)
    (root / "data" / "corporateActions.json").write_text(text)
    return str(root)


def dividend(ex: str, amount: str, payment="2019-04-01", **fields) -> dict:
    out = {"ex_date": ex, "payment_date": payment, "dividend": amount}
    return out | {"dividend_type": "interim", "fiscal_year": "2018"} | fields


def week_dividends():
    return {
        "LATE.JK": [dividend(TUE, "6.0", payment="April")],
        "PAYS.JK": [dividend(WED, "25"), dividend("2018-11-01", "3")],
        "GONE.JK": [dividend(WED, "2.5")],
    }


def write_dividends(root: Path, body=None, revision=DIVIDEND_REV) -> str:
    manifest(root, DIVIDEND_ID, revision)
    text = json.dumps(week_dividends() if body is None else body)
    (root / "all_dividends.json").write_text(text)
    return str(root)
