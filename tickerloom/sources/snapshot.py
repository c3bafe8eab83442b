"""Files of an immutable snapshot folder: listing, hashes, identity, manifest.

Folders are listed in tasks, and files are read in tasks, each once: its
size, its SHA-256 and its content are those of the same bytes. Every file counts, whatever
its name and also without bytes (Spark's own file sources leave out names that begin with
``.`` or ``_``). A file is the unit of hashing, so one task reads it whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.plans import folders

MANIFEST_NAME = "manifest.json"


class StructuralError(ValueError):
    """The snapshot does not have the supported structure; nothing is loaded."""


@dataclass(frozen=True)
class Manifest:
    """How and when the snapshot was obtained."""

    source_id: str
    source_url: str
    revision: str
    archive_sha256: str | None
    retrieved_at: datetime
    licence_reference: str


def read_manifest(
    spark: SparkSession, root: str, source_id: str, default_url: str, default_licence: str
) -> Manifest:
    """The snapshot's manifest with defaults filled in."""
    path = f"{root.rstrip('/')}/{MANIFEST_NAME}"
    try:
        raw = json.loads(folders.read_text(spark, path))
    except Py4JJavaError as exc:
        raise StructuralError(f"cannot read {path}") from exc
    except json.JSONDecodeError as exc:
        raise StructuralError(f"cannot read {path}: {exc}") from exc
    if raw.get("source_id") != source_id:
        raise StructuralError(f"manifest is for {raw.get('source_id')!r}, not {source_id!r}")
    absent = [k for k in ("retrieved_at", "revision") if k not in raw]
    if absent:
        raise StructuralError(f"{path}: incomplete manifest, no {absent}")
    try:
        retrieved = datetime.fromisoformat(str(raw["retrieved_at"]))
    except ValueError as exc:
        raise StructuralError(f"{path}: incomplete manifest ({exc})") from exc
    licence = str(raw.get("licence", default_licence))
    if raw.get("licence_read_on"):
        licence = f"{licence}; read {raw['licence_read_on']}"
    return Manifest(
        source_id,
        str(raw.get("source_url", default_url)),
        str(raw["revision"]),
        str(raw["archive_sha256"]) if raw.get("archive_sha256") else None,
        retrieved,
        licence,
    )


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified folder, and the folder's path in it.

    The path is taken as it is: characters that mean something in a pattern or in a URI do
    not here.
    """
    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    host, _, path = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system, f"{base.rstrip('/')}/{path}"


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """``(relative_path, size_bytes)`` of every file below a folder but its manifest.

    One task lists the first two levels; the folders found there are dealt to tasks, each
    of which lists all that lies below. No name reaches the driver.
    """
    if not folders.exists(spark, root):
        raise StructuralError(f"snapshot folder {root} does not exist")
    base = folders.qualified(spark, root)

    def rows(found: list[fs.FileInfo], top: str) -> pa.RecordBatch:
        return pa.record_batch(
            [
                pa.array([i.path[len(top) :].lstrip("/") for i in found], pa.string()),
                pa.array([i.size if i.is_file else None for i in found], pa.int64()),
            ],
            names=["relative_path", "size_bytes"],
        )

    def first_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(base)
        for batch in batches:
            for _ in range(batch.num_rows):
                for info in system.get_file_info(fs.FileSelector(top)):
                    deeper = fs.FileSelector(info.path)
                    yield rows([info] if info.is_file else system.get_file_info(deeper), top)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(base)
        for batch in batches:
            paths, sizes = (batch.column(c).to_pylist() for c in ("relative_path", "size_bytes"))
            waiting = [f"{top}/{p}" for p, s in zip(paths, sizes, strict=True) if s is None]
            yield batch.filter(batch.column("size_bytes").is_valid())
            while waiting:
                found = system.get_file_info(fs.FileSelector(waiting.pop()))
                waiting += [i.path for i in found if not i.is_file]
                yield rows([i for i in found if i.is_file], top)

    schema = "relative_path string, size_bytes bigint"
    top = spark.range(1).mapInArrow(first_levels, schema)
    spread = top.repartition(spark.sparkContext.defaultParallelism, "relative_path")
    return spread.mapInArrow(below, schema).filter(F.col("relative_path") != MANIFEST_NAME)


def read_files(files: DataFrame, root: str) -> DataFrame:
    """``(relative_path, size_bytes, sha256, content)`` of listed files; others are not opened."""
    spark = files.sparkSession
    base = folders.qualified(spark, root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(base)
        for batch in batches:
            for name in batch.column("relative_path").to_pylist():
                with system.open_input_file(f"{top}/{name}") as file:
                    content = file.read()
                digest = hashlib.sha256(content).hexdigest()
                yield pa.record_batch(
                    [pa.array([name]), pa.array([len(content)], pa.int64()), pa.array([digest]), pa.array([content], pa.binary())],
                    names=["relative_path", "size_bytes", "sha256", "content"],
                )

    # A folder may hold all files, so they are dealt to tasks by name, several to a core.
    spread = files.select("relative_path").repartition(2 * spark.sparkContext.defaultParallelism, "relative_path")
    return spread.mapInArrow(read, "relative_path string, size_bytes bigint, sha256 string, content binary")


def snapshot_files(spark: SparkSession, root: str, only: Column | None = None) -> DataFrame:
    """``(relative_path, size_bytes, sha256, content)`` of every file but the manifest.

    `only` is a condition on the path; files that do not meet it are listed, not opened.
    """
    files = listed_files(spark, root)
    return read_files(files if only is None else files.filter(only), root)


def listing_hashes(files: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """SHA-256 of each group's sorted ``path NUL sha256 LF`` listing.

    A flat hash has to read its listing in order. Sorted rows stream through an
    incremental hash, so a listing of any length needs constant memory; only
    paths and hashes take part, never file content.
    """
    keys = list(group)
    line = F.concat("relative_path", F.lit("\0"), "sha256", F.lit("\n")).alias("line")
    rows = files.select(*keys, "relative_path", line)
    spread = rows.repartition(*keys) if keys else rows.repartition(1)
    ordered = spread.sortWithinPartitions(*keys, "relative_path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, digest, count = None, None, 0
        for batch in batches:
            lines = batch["line"].tolist()
            owners = list(zip(*[batch[k] for k in keys])) if keys else [()] * len(batch)
            start = 0
            for i in range(1, len(owners) + 1):
                if i < len(owners) and owners[i] == owners[start]:
                    continue
                if digest is None or owners[start] != current:
                    if digest is not None:
                        yield _hash_row(keys, current, count, digest)
                    current, digest, count = owners[start], hashlib.sha256(), 0
                digest.update("".join(lines[start:i]).encode("utf-8"))
                count += i - start
                start = i
        if digest is not None:
            yield _hash_row(keys, current, count, digest)

    types = dict(rows.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["files bigint", "content_sha256 string"])
    return ordered.mapInPandas(run, schema)


def _hash_row(keys: Sequence[str], owner: tuple, count: int, digest) -> pd.DataFrame:
    row = dict(zip(keys, owner)) | {"files": count, "content_sha256": digest.hexdigest()}
    return pd.DataFrame([row])


def snapshot_id(source_id: Column, revision: Column, content_sha256: Column) -> Column:
    """Identity of a snapshot; retrieval time is not part of it."""
    return F.concat_ws(":", source_id, revision, F.substring(content_sha256, 1, 16))
