"""The engine's tables as parquet folders under one root, made visible by publication.

Rows are written to folders of their own, which nobody reads yet. A publication then names
all its folders, of any number of tables, in a manifest that appears by one rename. A
reader takes the newest manifest: it sees all of a publication or nothing, also when the
writer dies half way, and goes on reading the folders of the manifest it began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.plans import folders
from tickerloom.schemas import PARTITIONED_BY, table_schema


class ConcurrentPublication(RuntimeError):
    """A table changed between the decision and its publication; nothing was published."""


@dataclass(frozen=True)
class Manifest:
    """The folders that make up each table: ``{"folder": name, "scope": {...} or None}``."""

    number: int
    tables: Mapping[str, list[dict[str, Any]]]


class Store:
    """Reads and appends the engine's tables.

    Facts are only appended. Small tables whose rows change (runs, securities,
    source keys) get a new row with a higher ``version``; `current` returns the
    newest one per key. Derived tables are replaced one scope at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def manifest(self) -> Manifest:
        """What is published: the manifest of the highest number, which names everything."""
        found = [n for n in folders.names(self.spark, f"{self.root}/_published") if n.endswith(".json")]
        if not found:
            return Manifest(0, {})
        last = max(found)
        tables = json.loads(folders.read_text(self.spark, f"{self.root}/_published/{last}"))
        return Manifest(int(last.removesuffix(".json")), tables)

    def put(self, manifest: Manifest) -> bool:
        """Publish `manifest` unless another one took its number."""
        name = f"{self.root}/_published/{manifest.number:010d}.json"
        return folders.put_text(self.spark, name, json.dumps(manifest.tables, sort_keys=True))

    def read(self, table: str) -> DataFrame:
        return self._read(table, self.manifest().tables.get(table, []))

    def _read(self, table: str, entries: Sequence[Mapping[str, Any]]) -> DataFrame:
        schema = table_schema(table)
        if not entries:
            return self.spark.createDataFrame([], schema)
        base = self.path(table)
        found = self.spark.read.schema(schema).option("basePath", base)
        return found.parquet(*[f"{base}/{e['folder']}" for e in entries]).select(*schema.fieldNames())

    def current(self, table: str, key: Sequence[str]) -> DataFrame:
        """The newest version of every row."""
        columns = [f.name for f in table_schema(table) if f.name not in key]
        newest = F.max_by(F.struct(*columns), F.col("version")).alias("r")
        return self.read(table).groupBy(*key).agg(newest).select(*key, "r.*")

    def begin(self) -> Publication:
        return Publication(self)

    def append(self, table: str, df: DataFrame) -> None:
        with self.begin() as publication:
            publication.append(table, df)

    def append_rows(self, table: str, rows: Sequence[Mapping[str, Any]]) -> None:
        """Append a few driver-made rows (runs, builds, snapshots)."""
        with self.begin() as publication:
            publication.append_rows(table, rows)

    def replace_scope(self, table: str, df: DataFrame, scope: Mapping[str, str]) -> None:
        with self.begin() as publication:
            publication.replace_scope(table, df, scope)

    def stage(self, run_id: str, step: str, df: DataFrame) -> DataFrame:
        """Write `df` under the run's own folder and read it back.

        What follows reads the written copy, so later appends to the tables `df`
        came from cannot change it and lost executors cost no recomputation.
        """
        path = f"{self.root}/_staging/{run_id}/{step}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, run_id: str) -> None:
        """Remove what the run staged."""
        folders.remove(self.spark, f"{self.root}/_staging/{run_id}")

    def vacuum(self) -> list[str]:
        """Remove and return folders that no table consists of any more.

        For times without writers and long readers: replaced scopes and the folders of
        publications that never happened are left where they are until then.
        """
        tables = self.manifest().tables
        gone = []
        for table in folders.names(self.spark, self.root):
            if table.startswith("_"):
                continue
            kept = {e["folder"].split("/")[0] for e in tables.get(table, [])}
            gone += [f"{table}/{n}" for n in folders.names(self.spark, self.path(table)) if n not in kept]
        for name in gone:
            folders.remove(self.spark, f"{self.root}/{name}")
        return sorted(gone)

    def shape(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in table_schema(table)
            ]
        )


class Publication:
    """Folders of several tables that become visible together, or not at all.

    As a context manager it publishes at the end of the block, unless the block did so, and
    removes what it wrote if the block or the publication fails.
    """

    def __init__(self, store: Store) -> None:
        self.store, self.began = store, store.manifest()
        self.name = uuid.uuid4().hex
        self.added: dict[str, list[dict[str, Any]]] = {}
        self.done = False

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is not None:
            self.abandon()
        elif not self.done:
            self.publish()

    def append(self, table: str, df: DataFrame) -> None:
        writer = self.store.shape(table, df).write
        if table in PARTITIONED_BY:
            writer = writer.partitionBy(*PARTITIONED_BY[table])
        writer.parquet(f"{self.store.path(table)}/{self._folder(table, None)}")

    def append_rows(self, table: str, rows: Sequence[Mapping[str, Any]]) -> None:
        fields = table_schema(table)
        made = [
            self.store.spark.range(1).select(
                *[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name) for f in fields]
            )
            for r in rows
        ]
        for one in made:
            self.append(table, one.coalesce(1))

    def replace_scope(self, table: str, df: DataFrame, scope: Mapping[str, str]) -> None:
        """Let `df` be all rows of one scope (a value for each partition column).

        It may have no rows, and may be read from the scope it replaces.
        """
        parts = "/".join(f"{c}={scope[c]}" for c in PARTITIONED_BY[table])
        columns = [f.name for f in table_schema(table) if f.name not in scope]
        folder = f"{self._folder(table, dict(scope))}/{parts}"
        self.added[table][-1]["folder"] = folder
        self.store.shape(table, df).select(*columns).write.parquet(f"{self.store.path(table)}/{folder}")

    def _folder(self, table: str, scope: dict[str, str] | None) -> str:
        mine = self.added.setdefault(table, [])
        mine.append({"folder": f"load={self.name}-{len(mine)}", "scope": scope})
        return mine[-1]["folder"]

    def written(self, table: str) -> DataFrame:
        """What this publication adds to a table, read back."""
        return self.store._read(table, self.added.get(table, []))

    def publish(self, unchanged: Sequence[str] = ()) -> None:
        """Make everything visible by one rename.

        Tables in `unchanged` must be as they were when the publication began. Other
        writers' additions to the rest are kept.
        """
        try:
            while True:
                now = self.store.manifest()
                moved = [t for t in unchanged if now.tables.get(t) != self.began.tables.get(t)]
                if moved:
                    raise ConcurrentPublication(f"published by another writer meanwhile: {moved}")
                tables = dict(now.tables)
                for table, entries in self.added.items():
                    scopes = [e["scope"] for e in entries if e["scope"] is not None]
                    kept = [e for e in tables.get(table, []) if e["scope"] is None or e["scope"] not in scopes]
                    tables[table] = kept + entries
                if self.store.put(Manifest(now.number + 1, tables)):
                    self.done = True
                    return
        except Exception:
            self.abandon()
            raise

    def abandon(self) -> None:
        """Remove what was written, unless it is published."""
        if self.done:
            return
        for table, entries in self.added.items():
            for e in entries:
                folders.remove(self.store.spark, f"{self.store.path(table)}/{e['folder'].split('/')[0]}")
        self.added = {}
