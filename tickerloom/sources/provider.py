"""Read-only access to the price files of a snapshot, without a store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.normalize import record_ref
from tickerloom.functions.validate import hard_price_codes
from tickerloom.operators.dedupe import key_groups, require_no_conflicts
from tickerloom.plans.durable import durable
from tickerloom.schemas import PRICE_OBSERVATION
from tickerloom.sources.adapters import STOCK_PATH, StockCsvSource
from tickerloom.sources.snapshot import StructuralError, listed_files, read_files, snapshot_files


class NotProvided(NotImplementedError):
    """The source does not supply this kind of data. An empty result would say,
    wrongly, that there is none."""


class UnknownSecurity(KeyError):
    """The security is not in the snapshot."""


class InvalidPrices(ValueError):
    """Hard-invalid or unreadable rows were found; nothing is returned."""


def read_range(prices: DataFrame, start: str, end: str) -> DataFrame:
    """Rows dated from `start` to `end`, both included."""
    if str(start) > str(end):
        raise ValueError(f"start {start} is after end {end}")
    day = F.col("trading_date")
    return prices.filter(day.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


@dataclass(frozen=True)
class SnapshotPrices:
    """Price data of one snapshot folder."""

    spark: SparkSession
    source: StockCsvSource
    root: str

    def _rows(self) -> DataFrame:
        return self.source.rows(snapshot_files(self.spark, self.root))

    def security_file(self, security_id: str) -> DataFrame:
        """The listed file of one security; raises if there is none."""
        key = self.spark.range(1).select(self.source.source_key(F.lit(security_id))).first()[0]
        named = self.source.classify(F.col("relative_path")) == "stock"
        mine = F.regexp_extract("relative_path", STOCK_PATH, 1) == F.lit(key)
        found = durable(listed_files(self.spark, self.root).filter(named & mine))
        if key is None or found.isEmpty():
            raise UnknownSecurity(security_id)
        return found

    def _security_rows(self, security_id: str) -> DataFrame:
        """Rows of one security; no other file is opened."""
        files = durable(read_files(self.security_file(security_id), self.root))
        broken = self.source.inspected(files).filter("problem IS NOT NULL").select("problem").first()
        if broken:
            raise StructuralError(f"{security_id}: {broken[0]}")
        return self.source.rows(files)

    def list_securities(self) -> DataFrame:
        """One row per stock file, named by its newest row."""
        stock = self.source.inspected(snapshot_files(self.spark, self.root)).filter("role = 'stock'")
        return stock.select(
            self.source.security_id_text(F.col("source_key")).alias("security_id"),
            F.col("source_key").alias("ticker"),
            F.col("newest_name").alias("name"),
            "newest_date",
            "sha256",
        )

    def strict_rows(self) -> DataFrame:
        """All rows; the first lines of the wrong width raise."""
        rows = self._rows()
        malformed = F.get("reasons", F.lit(0)).rlike("^[0-9]+ fields, expected")
        self._require_none(rows.filter(malformed))
        return rows

    def daily_prices(self, start: str, end: str, security_id: str | None = None) -> DataFrame:
        """Validated rows in a date range, of one security or of all.

        Hard-invalid rows and conflicting duplicates raise with up to five
        examples. Expected conditions (no open, no trade) are returned.
        """
        if str(start) > str(end):
            raise ValueError(f"start {start} is after end {end}")
        rows = self._rows() if security_id is None else self._security_rows(security_id)
        # Read three times below; written once so that files are parsed once.
        judged = durable(
            rows.withColumn(
                "reasons",
                F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(hard_price_codes()),
            )
        )
        self._require_none(judged.filter(F.size("reasons") > 0))
        groups = key_groups(
            judged,
            ["source_key", "trading_date"],
            PRICE_OBSERVATION,
            F.col("source_line"),
            ["relative_path", "sha256", "source_line", *PRICE_OBSERVATION],
        )
        clean = require_no_conflicts(groups, ["source_key", "trading_date"])
        return read_range(clean, start, end).select(
            self.source.security_id_text(F.col("source_key")).alias("security_id"),
            "trading_date",
            *PRICE_OBSERVATION,
            record_ref(F.col("relative_path"), F.col("sha256"), F.col("source_line")).alias(
                "raw_record_ref"
            ),
        )

    def dividends(self, *_: object) -> DataFrame:
        raise NotProvided("this source does not supply dividends")

    def corporate_actions(self, *_: object) -> DataFrame:
        raise NotProvided("this source does not supply corporate actions")

    def index_history(self, *_: object) -> DataFrame:
        raise NotProvided("this source does not supply index history")

    @staticmethod
    def _require_none(bad: DataFrame) -> None:
        ref = record_ref(F.col("relative_path"), F.col("sha256"), F.col("source_line"))
        least = bad.orderBy("relative_path", "source_line").limit(5)
        found = least.select(ref.alias("ref"), F.array_join("reasons", ",").alias("why")).collect()
        if found:
            raise InvalidPrices("; ".join(f"{r['ref']}: {r['why']}" for r in found))


__all__ = ["InvalidPrices", "NotProvided", "SnapshotPrices", "UnknownSecurity", "read_range"]
