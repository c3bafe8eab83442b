"""Incident rows: what was rejected, collapsed with a warning, or in conflict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.plans.store import Publication, Store

NULLS = {"ignoreNullFields": "false"}
def draft(
    df: DataFrame,
    incident_type: str,
    severity: str,
    details: Column,
    *,
    source_key: Column | None = None,
    trading_date: Column | None = None,
    relative_path: Column | None = None,
    source_line: Column | None = None,
    identity: Column | None = None,
) -> DataFrame:
    """Incident drafts with their fingerprint.

    `details` is a struct. `identity` is the struct that makes two incidents the
    same one; by default it is the whole draft.
    """

    def optional(value: Column | None, kind: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind)

    shaped = df.select(
        F.lit(incident_type).alias("incident_type"),
        F.lit(severity).alias("severity"),
        optional(source_key, "string").alias("source_key"),
        optional(trading_date, "date").alias("trading_date"),
        optional(relative_path, "string").alias("relative_path"),
        optional(source_line, "int").alias("source_line"),
        F.to_json(details, NULLS).alias("details"),
        *([] if identity is None else [F.sha2(F.to_json(identity, NULLS), 256).alias("fingerprint")]),
    )
    return shaped if identity is not None else shaped.withColumn("fingerprint", fingerprint())


def fingerprint() -> Column:
    """SHA-256 of an incident's content; equal content gives one incident."""
    names = ("incident_type", "source_key", "trading_date", "relative_path", "source_line", "details")
    return F.sha2(F.to_json(F.struct(*sorted(names)), NULLS), 256)


def as_text(*columns: str) -> Column:
    """The columns as a struct of texts, so JSON keeps every decimal."""
    return F.struct(*[F.col(c).cast("string").alias(c) for c in columns])


def new_incidents(drafts: DataFrame, stored: DataFrame) -> DataFrame:
    """Drafts whose fingerprint is not stored for the source, one per fingerprint."""
    return drafts.dropDuplicates(["fingerprint"]).join(
        stored.select("fingerprint"), "fingerprint", "left_anti"
    )


def append_incidents(
    store: Store,
    publication: Publication,
    drafts: DataFrame,
    source_id: str,
    run_id: str,
    keys: DataFrame,
    files: DataFrame,
) -> int:
    """Add the new drafts with security and file ids to a publication; returns how many.

    `keys` maps source_key to security_id, `files` relative_path to file_id. Drafts
    without a key meet none, so they stay out of that join and never gather in its tasks.
    """
    stored = store.read("data_quality_incidents").filter(F.col("source_id") == source_id)
    fresh = new_incidents(drafts, stored)
    keyed = fresh.filter("source_key IS NOT NULL").join(
        keys.select("source_key", "security_id"), "source_key", "left"
    )
    loose = fresh.filter("source_key IS NULL").withColumn("security_id", F.lit(None).cast("bigint"))
    linked = (
        keyed.unionByName(loose)
        .join(files.select("relative_path", "file_id"), "relative_path", "left")
        .withColumns(
            {
                "ingestion_run_id": F.lit(run_id),
                "status": F.lit("open"),
                "source_id": F.lit(source_id),
            }
        )
    )
    publication.append("data_quality_incidents", linked)
    return publication.written("data_quality_incidents").count()
