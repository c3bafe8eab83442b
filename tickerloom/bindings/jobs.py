"""Whole loads of derived snapshots, run once per session for the queries that look at them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.bindings import derived, files
from tickerloom.bindings.derived import SOURCE, Tables
from tickerloom.plans.folders import remove_at_end
from tickerloom.plans.load_prices import load_prices
from tickerloom.plans.load_records import load_records
from tickerloom.plans.registration import LoadFailed, Prepared, prepare_prices, prepare_records
from tickerloom.plans.store import Store
from tickerloom.sources.adapters import (
    ActionsJsonSource,
    DividendsJsonSource,
    IndexCsvSource,
    RecordSource,
    StockCsvSource,
)
from tickerloom.sources.snapshot import Manifest

STOCK, INDEX = StockCsvSource(SOURCE), IndexCsvSource(f"{SOURCE}-index")
FETCHED = datetime(2026, 1, 1, tzinfo=UTC)
_DONE: dict[tuple[str, str], Store] = {}


@dataclass(frozen=True)
class BlockActions(ActionsJsonSource):
    """Events in one document a block."""

    def is_data_file(self, path: Column) -> Column:
        return path.rlike(r"^block-[0-9]+/corporateActions\.json\z")


@dataclass(frozen=True)
class BlockDividends(DividendsJsonSource):
    """Dividends in one document a block."""

    def is_data_file(self, path: Column) -> Column:
        return path.rlike(r"^block-[0-9]+/all_dividends\.json\z")


EVENTS, DIVIDENDS = BlockActions(f"{SOURCE}-events"), BlockDividends(f"{SOURCE}-dividends")


def manifest(source_id: str, edition: int) -> Manifest:
    return Manifest(source_id, "https://bench.invalid", f"r{edition}", None, FETCHED, "none")


def sized(found: DataFrame) -> DataFrame:
    return found.withColumn("size_bytes", F.octet_length("content"))


def prices(t: Tables, edition: int) -> Prepared:
    read = lambda: t.written(f"stock_edition_{edition}", lambda: files.stock_edition(t, edition))
    return prepare_prices(t.spark, STOCK, f"editions/{edition}", manifest=manifest(SOURCE, edition), read=read)


def records(t: Tables, source: RecordSource, edition: int, build: Callable[[], DataFrame]) -> Prepared:
    read = lambda: sized(t.written(f"{source.kept.table}_{edition}", build))
    return prepare_records(
        t.spark, source, f"editions/{edition}", manifest=manifest(source.source_id, edition), read=read
    )


def events(t: Tables, edition: int) -> Prepared:
    return records(t, EVENTS, edition, lambda: files.event_edition(t, edition))


def dividends(t: Tables) -> Prepared:
    return records(t, DIVIDENDS, 1, lambda: files.dividend_files(t))


def indices(t: Tables) -> Prepared:
    return records(t, INDEX, 1, lambda: files.index_files(t))


def once(t: Tables, name: str, fill: Callable[[Store], None]) -> Store:
    """A store of its own, filled once per session."""
    mark = (t.store.root, name)
    if mark not in _DONE:
        store = Store(t.spark, f"{t.store.root}-{name}-{uuid.uuid4().hex[:8]}")
        fill(store)
        remove_at_end(t.spark, store.root)
        _DONE[mark] = store
    return _DONE[mark]


def price_loads(t: Tables) -> Store:
    """The first edition, the same once more, and the second edition."""

    def fill(store: Store) -> None:
        for edition in (1, 1, 2):
            load_prices(store, prices(t, edition), confirm_revision=f"r{edition}")

    return once(t, "price-loads", fill)


def first_load(t: Tables) -> Store:
    """Only what the first run of `price_loads` published."""

    def fill(store: Store) -> None:
        source = price_loads(t)
        run = runs(source).filter("run = 1").select("ingestion_run_id")
        with store.begin() as publication:
            for table in ("data_sources", "securities", "security_source_keys", "source_snapshots", "source_files"):
                rows = source.read(table)
                if table in ("source_snapshots", "source_files"):
                    rows = rows.filter(F.col("snapshot_id").startswith(f"{SOURCE}:r1:"))
                if table in ("securities", "security_source_keys"):
                    first = rows.agg(F.min("version").alias("version"))
                    rows = rows.join(first, "version", "left_semi")
                publication.append(table, rows)
            for table in ("daily_prices", "data_quality_incidents", "ingestion_runs"):
                publication.append(table, source.read(table).join(run, "ingestion_run_id", "left_semi"))

    return once(t, "first-load", fill)


def failed_load(t: Tables) -> Store:
    """A load of files that change between the first and the second look at them."""

    def fill(store: Store) -> None:
        whole = prices(t, 1)
        newline = F.encode(F.lit("\r\n"), "UTF-8")

        def altered() -> DataFrame:
            odd = F.col("relative_path").rlike(r"0\.csv$")
            content = F.when(odd, F.concat("content", newline)).otherwise(F.col("content"))
            changed = whole.read().withColumn("content", content)
            return changed.withColumn("sha256", F.sha2("content", 256))

        later = replace(whole, read=altered)
        try:
            load_prices(store, later, confirm_revision="r1")
        except LoadFailed:
            pass

    return once(t, "failed-load", fill)


def adjusted_load(t: Tables) -> Store:
    """A load from a source that says its prices are adjusted."""

    @dataclass(frozen=True)
    class Adjusted(StockCsvSource):
        basis: str = "adjusted"

    def fill(store: Store) -> None:
        whole = prices(t, 1)
        try:
            load_prices(store, replace(whole, source=Adjusted(SOURCE)), confirm_revision="r1")
        except LoadFailed:
            pass

    return once(t, "adjusted-load", fill)


def record_loads(t: Tables) -> Store:
    """Events (twice the first edition, then the second), dividends and indices (twice each)."""

    def fill(store: Store) -> None:
        keys = derived.derive_keys(t.table("supplier")).withColumn("version", F.lit(1))
        store.append("security_source_keys", keys)
        for prepared, revision in ((events(t, 1), 1), (events(t, 1), 1), (events(t, 2), 2)):
            load_records(store, prepared, confirm_revision=f"r{revision}", price_source_id=SOURCE)
        for make in (dividends, dividends, indices, indices):
            load_records(store, make(t), confirm_revision="r1", price_source_id=SOURCE)

    return once(t, "record-loads", fill)


def runs(store: Store) -> DataFrame:
    """The store's runs (a handful) with their number in order of start, per source."""
    current = store.current("ingestion_runs", ["ingestion_run_id"])
    sources = store.read("source_snapshots").select("snapshot_id", "source_id", "source_revision")
    order = Window.partitionBy("source_id").orderBy("started_at")
    return current.join(sources, "snapshot_id").withColumn("run", F.row_number().over(order))


def counters(store: Store) -> DataFrame:
    """``(source_id, run, name, value)`` of every counter in the runs' summaries."""
    found = F.from_json(F.get_json_object("validation_summary", "$.counters"), "map<string, bigint>")
    return runs(store).select("source_id", "run", F.explode(found).alias("name", "value"))


def copied(source: Store, store: Store, *but: str) -> None:
    """Every published table of `source`, except those named, in one publication."""
    with store.begin() as publication:
        for table in source.manifest().tables:
            if table not in but:
                publication.append(table, source.read(table))


def tampered_prices(t: Tables) -> Store:
    """The first load with rows taken out, changed, moved to no file, and copied far ahead."""

    def fill(store: Store) -> None:
        source = first_load(t)
        line, day = F.col("source_line"), F.col("trading_date")
        rows = source.read("daily_prices").filter(line % 41 != 3).withColumns(
            {
                "close": F.when(line % 43 == 4, F.lit(-1).cast("decimal(20,4)")).otherwise(F.col("close")),
                "file_id": F.when(line % 37 == 6, F.lit(1 << 40)).otherwise(F.col("file_id")),
            }
        )
        ahead = rows.filter(line % 59 == 7).withColumn("trading_date", F.date_add(day, 3653))
        copied(source, store, "daily_prices")
        store.append("daily_prices", rows.unionByName(ahead))
        open_run = source.read("ingestion_runs").filter("status = 'succeeded'").limit(1)
        store.append(
            "ingestion_runs",
            open_run.withColumns({"ingestion_run_id": F.lit("left open"), "status": F.lit("running")}),
        )

    return once(t, "tampered-prices", fill)


def tampered_records(t: Tables) -> Store:
    """The record loads with events taken out and changed."""

    def fill(store: Store) -> None:
        source = record_loads(t)
        key = F.col("source_record_id").cast("bigint")
        label = F.when(key % 13 == 1, "y").otherwise(F.col("source_action_label"))
        rows = source.read("corporate_action_events").filter(key % 11 != 1).withColumn("source_action_label", label)
        copied(source, store, "corporate_action_events")
        store.append("corporate_action_events", rows)

    return once(t, "tampered-records", fill)
