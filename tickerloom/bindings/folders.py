"""Real snapshot folders of derived files, written by tasks to the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.bindings.derived import Tables
from tickerloom.plans.folders import qualified, remove_at_end
from tickerloom.sources.snapshot import opened

_WRITTEN: dict[tuple[str, str], str] = {}


def folder(t: Tables, name: str, files: DataFrame) -> str:
    """The folder that holds `files` (relative_path, content), written once per session."""
    mark = (t.store.root, name)
    if mark in _WRITTEN:
        return _WRITTEN[mark]
    root = f"{t.store.root}-{name}-{uuid.uuid4().hex[:8]}"
    base = qualified(t.spark, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(base)
        for batch in batches:
            paths, contents = (batch.column(c).to_pylist() for c in ("relative_path", "content"))
            for path, content in zip(paths, contents, strict=True):
                whole = f"{top}/{path}"
                system.create_dir(whole.rpartition("/")[0], recursive=True)
                # A task that is run again writes the same bytes.
                with system.open_output_stream(whole) as out:
                    out.write(content)
            yield pa.record_batch([pa.array([len(paths)], pa.int64())], names=["files"])

    written = files.select("relative_path", "content").mapInArrow(write, "files bigint")
    written.agg(F.sum("files")).collect()
    remove_at_end(t.spark, root)
    _WRITTEN[mark] = root
    return root
