"""Source adapters: what the loaders need to know about one kind of snapshot.

A price source reads one CSV per security, a record source yields keyed records. A new
source is a subclass that says how its files are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.normalize import (
    index_rows,
    price_rows,
    source_key,
    security_id_text,
    strip,
    trade_date,
    cell,
)
from tickerloom.schemas import (
    DIVIDEND_KEY,
    DIVIDEND_OBSERVATION,
    EVENT_KEY,
    EVENT_OBSERVATION,
    INDEX_KEY,
    INDEX_OBSERVATION,
)
from tickerloom.sources import json_records
from tickerloom.sources.csv_lines import (
    data_rows,
    exploded_records,
    with_data_row_count,
    with_heads,
)
from tickerloom.sources.snapshot import Manifest, StructuralError, read_manifest

# ---- fixed values: snapshot layout and CSV headers --------------------------
STOCK_FOLDER = "dataset/stocks/"
STOCK_PATH = r"^dataset/stocks/csv/([A-Z0-9]+)\.csv\z"
INDEX_ROLE_FOLDER = "dataset/indices/"
INDEX_FOLDER = "dataset/indices/csv/"
INDEX_PATH = r"^dataset/indices/csv/([A-Za-z0-9-]+)\.csv\z"
PREVIEW_FOLDER = "dataset/preview/"
ACTIONS_FILE = "data/corporateActions.json"
DIVIDENDS_FILE = "all_dividends.json"
STOCK_HEADER = (
    "Date",
    "Ticker",
    "Name",
    "Remarks",
    "Previous",
    "Open",
    "High",
    "Low",
    "Close",
    "Change",
    "Volume",
    "Value",
    "Frequency",
    "IndexIndividual",
    "Offer",
    "OfferVolume",
    "Bid",
    "BidVolume",
    "ListedShares",
    "TradebleShares",
    "WeightForIndex",
    "ForeignSell",
    "ForeignBuy",
    "NonRegularVolume",
    "NonRegularValue",
    "NonRegularFrequency",
)
#: Basis of prices as they were traded.
RAW = "raw"
INDEX_HEADER = (
    "Date",
    "Previous",
    "Highest",
    "Lowest",
    "Close",
    "Constituent",
    "Change",
    "Volume",
    "Value",
    "Frequency",
    "Capitalization",
)


@dataclass(frozen=True)
class Source:
    """Who publishes a snapshot, under what name and with which parser it is read."""

    source_id: str
    source_name: str = "daily market data (development source)"
    homepage_url: str | None = None
    default_licence: str = "not stated"
    parser_version: str = ""

    def manifest(self, spark: SparkSession, root: str) -> Manifest:
        return read_manifest(
            spark, root, self.source_id, self.homepage_url or "", self.default_licence
        )


class PriceSource(Source):
    """A source of one price file per security.

    `basis` says whether prices are as traded (`RAW`) or adjusted by the vendor.
    """

    basis: str = RAW

    def inspected(self, files: DataFrame) -> DataFrame:
        """Facts of every file: role, key, rows, newest name and date, problem."""
        raise NotImplementedError

    def rows(self, files: DataFrame) -> DataFrame:
        """Every data line, normalised, with the reasons against it."""
        raise NotImplementedError


@dataclass(frozen=True)
class Kept:
    """How the records of a source are kept: the table, what tells them apart, what they say.

    `place` is where a record stands in its file, `day` the date of its incidents,
    `number` the column of its own ids. Records that are `tickered` are linked to
    securities by ticker text.
    """

    table: str
    key: tuple[str, ...]
    says: tuple[str, ...]
    day: str
    place: str
    number: str | None = None
    tickered: bool = False


class RecordSource(Source):
    """A source of keyed records."""

    kept: Kept

    def is_data_file(self, path: Column) -> Column:
        raise NotImplementedError

    def is_unexpected(self, path: Column) -> Column:
        return F.lit(False)

    def problems(self, files: DataFrame) -> DataFrame:
        """``(relative_path, problem)`` of files that cannot be read at all."""
        raise NotImplementedError

    def records(self, files: DataFrame) -> DataFrame:
        """Every record, normalised, with the reasons against it."""
        raise NotImplementedError

    def record_count(self, files: DataFrame) -> DataFrame:
        """``(relative_path, row_count)`` of every data file with records."""
        return self.records(files).groupBy("relative_path").agg(
            F.count(F.lit(1)).cast("int").alias("row_count")
        )


def header_is(cells: Column, header: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(h) for h in header])
    return F.coalesce(cells == wanted, F.lit(False))


def structure_problem(cells: Column, header: Sequence[str]) -> Column:
    """Why a CSV file with these `cells` in its first record cannot be read at all, NULL when it can."""
    return F.when(cells.isNull(), "not valid UTF-8").when(
        ~header_is(cells, header), "unexpected header"
    )


@dataclass(frozen=True)
class StockCsvSource(PriceSource):
    """One CSV per security under the stock folder; the file name is the key."""

    parser_version: str = "stock-csv-1"

    @property
    def id_prefix(self) -> str:
        return f"dev:{self.source_id}:"

    def security_id_text(self, key: Column) -> Column:
        return security_id_text(self.id_prefix, key)

    def source_key(self, security_id: Column) -> Column:
        return source_key(self.id_prefix, security_id)

    def classify(self, path: Column) -> Column:
        """Role of a file; a stray file in the stock folder has the role NULL."""
        return (
            F.when(path.rlike(STOCK_PATH), "stock")
            .when(path.startswith(STOCK_FOLDER), F.lit(None).cast("string"))
            .when(path.startswith(INDEX_ROLE_FOLDER), "index")
            .when(path.startswith(PREVIEW_FOLDER), "preview")
            .otherwise("other")
        )

    def inspected(self, files: DataFrame) -> DataFrame:
        """Per-file facts, computed inside each row: no lines are shuffled.

        The name comes from the newest date; on a tie the first line wins.
        """
        path = F.col("relative_path")
        is_csv = path.endswith(".csv")
        stock = F.col("role") == "stock"
        # Rows of other files are only counted: what is no UTF-8 there is replaced.
        lenient = F.make_valid_utf8(F.col("content").cast("string")).cast("binary")
        content = (
            F.when(self.classify(path) == "stock", F.col("content"))
            .when(is_csv, lenient)
            .alias("content")
        )
        # The header names them at the start of a line; nothing else of a line is kept.
        first = 1 + max(STOCK_HEADER.index(n) for n in ("Date", "Ticker", "Name"))
        body = F.slice("heads", F.lit(2), F.greatest(F.size("heads"), F.lit(1)))
        good = F.filter(body, lambda r: r["width"] == len(STOCK_HEADER))
        parsed = with_heads(
            files.select(
                "relative_path", "sha256", "size_bytes", self.classify(path).alias("role"), content
            ),
            first,
        ).withColumn("good", F.when(stock, good))
        dated = F.transform(
            "good",
            lambda r: F.struct(
                trade_date(cell(r["cells"], STOCK_HEADER, "Date")).alias("date"),
                (-r["line"]).alias("order"),
                r["cells"].alias("cells"),
            ),
        )
        newest = F.array_max(F.filter(dated, lambda d: d["date"].isNotNull()))
        name = F.nullif(strip(cell(F.col("newest.cells"), STOCK_HEADER, "Name")), F.lit(""))
        key = F.regexp_extract(path, STOCK_PATH, 1)
        # Few texts are different ones, so they are told apart before they are looked at.
        tickers = F.array_distinct(F.transform("good", lambda r: cell(r["cells"], STOCK_HEADER, "Ticker")))
        by_case = F.filter(
            F.array_distinct(F.transform(tickers, strip)), lambda t: (t != key) & (F.upper(t) == key)
        )
        parsed = parsed.withColumn("newest", F.when(stock, newest))
        return parsed.select(
            "relative_path",
            "sha256",
            "size_bytes",
            "role",
            F.when(is_csv, F.coalesce(data_rows(F.col("heads")), F.lit(0)))
            .otherwise(0)
            .cast("int")
            .alias("row_count"),
            F.when(stock, key).alias("source_key"),
            F.when(stock, structure_problem(F.col("header"), STOCK_HEADER)).alias("problem"),
            F.when(stock, name).alias("newest_name"),
            F.when(stock, F.col("newest.date")).alias("newest_date"),
            F.when(stock, F.array_sort(by_case)).alias("ticker_mismatch_values"),
        )

    def rows(self, files: DataFrame) -> DataFrame:
        """Every data line of the stock files, normalised, with its reasons."""
        stock = files.filter(F.col("relative_path").rlike(STOCK_PATH))
        lines = exploded_records(
            stock,
            "relative_path",
            "sha256",
            F.regexp_extract("relative_path", STOCK_PATH, 1).alias("source_key"),
        ).filter("line > 1")
        return price_rows(
            lines.select(
                "relative_path", "sha256", "source_key", F.col("line").alias("source_line"), "cells"
            ),
            STOCK_HEADER,
            "source_key",
        )


@dataclass(frozen=True)
class IndexCsvSource(RecordSource):
    """One CSV per index; the file name is the index code."""

    parser_version: str = "index-csv-1"
    kept: Kept = Kept("index_daily_values", INDEX_KEY, INDEX_OBSERVATION, "trading_date", "source_line")

    def is_data_file(self, path: Column) -> Column:
        return path.rlike(INDEX_PATH)

    def is_unexpected(self, path: Column) -> Column:
        return path.startswith(INDEX_FOLDER) & ~path.rlike(INDEX_PATH)

    def problems(self, files: DataFrame) -> DataFrame:
        problem = structure_problem(F.col("header"), INDEX_HEADER)
        return (
            with_heads(files.select("relative_path", "content"), 1)
            .select("relative_path", problem.alias("problem"))
            .filter("problem IS NOT NULL")
        )

    def record_count(self, files: DataFrame) -> DataFrame:
        return with_data_row_count(files.select("relative_path", "content")).select(
            "relative_path", "row_count"
        )

    def records(self, files: DataFrame) -> DataFrame:
        lines = exploded_records(
            files,
            "relative_path",
            "sha256",
            F.regexp_extract("relative_path", INDEX_PATH, 1).alias("index_code"),
        ).filter("line > 1")
        return index_rows(lines, INDEX_HEADER).select(
            "*",
            F.col("line").alias("position"),
            F.col("line").cast("string").alias("record_ref"),
            F.col("line").alias("source_line"),
            F.lit(None).cast("string").alias("match_key"),
            F.to_json("cells").alias("raw"),
            F.array().cast(json_records.ISSUES).alias("issues"),
        ).drop("line", "cells")


class _OneJsonFile(RecordSource):
    data_file: str

    def is_data_file(self, path: Column) -> Column:
        return path == self.data_file


@dataclass(frozen=True)
class ActionsJsonSource(_OneJsonFile):
    """Corporate-action events in one JSON file, grouped by category."""

    parser_version: str = "actions-json-1"
    kept: Kept = Kept(
        "corporate_action_events", EVENT_KEY, EVENT_OBSERVATION, "registration_date", "record_ref", "event_id", True
    )
    data_file: str = ACTIONS_FILE

    def problems(self, files: DataFrame) -> DataFrame:
        return json_records.action_problems(files)

    def records(self, files: DataFrame) -> DataFrame:
        return json_records.action_records(files)


@dataclass(frozen=True)
class DividendsJsonSource(_OneJsonFile):
    """Cash dividends in one JSON file, keyed by ticker."""

    parser_version: str = "dividends-json-1"
    kept: Kept = Kept(
        "cash_dividends", DIVIDEND_KEY, DIVIDEND_OBSERVATION, "ex_date", "record_ref", "dividend_id", True
    )
    data_file: str = DIVIDENDS_FILE

    def problems(self, files: DataFrame) -> DataFrame:
        return json_records.dividend_problems(files)

    def records(self, files: DataFrame) -> DataFrame:
        return json_records.dividend_records(files)


def data_files(source: RecordSource, files: DataFrame) -> DataFrame:
    """The files holding records; raises when there are none or strays exist."""
    path = F.col("relative_path")
    strays = files.filter(source.is_unexpected(path)).select(path).orderBy(path).limit(5).collect()
    if strays:
        raise StructuralError(f"unexpected files {[r[0] for r in strays]}")
    chosen = files.filter(source.is_data_file(path))
    if chosen.select(path).isEmpty():
        raise StructuralError("data files missing from the snapshot")
    return chosen
