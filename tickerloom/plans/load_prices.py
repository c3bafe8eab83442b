"""Load a price snapshot: quarantine, de-duplicate, compare, append what is new."""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.normalize import merge_flag
from tickerloom.functions.validate import hard_price_codes
from tickerloom.operators.dedupe import accepted, batch_conflicts, duplicate_keys, key_groups
from tickerloom.operators.ids import with_dense_ids
from tickerloom.operators.quality import flag_counts, observation_stats, status_counts
from tickerloom.operators.upsert import CONFLICT, NEW, UNCHANGED, classify
from tickerloom.plans.incidents import append_incidents, as_text, draft
from tickerloom.plans.registration import (
    LoadFailed,
    Prepared,
    Run,
    balance,
    balanced,
    changed_files,
    confirm,
    mark_failed,
    mismatch_drafts,
    outcome_rows,
    register,
    run_row,
    staging,
)
from tickerloom.plans.store import Publication, Store
from tickerloom.schemas import KEY_FLAGS, PRICE_KEY, PRICE_OBSERVATION, PRICE_PROVENANCE
from tickerloom.sources.adapters import RAW
from tickerloom.sources.snapshot import StructuralError


@dataclass(frozen=True)
class Outcome:
    """Second pass over the stock files, before any stored table is read."""

    rows: DataFrame
    groups: DataFrame
    rejected_files: DataFrame
    accepted: DataFrame
    drafts: DataFrame


def quarantine(rows: DataFrame) -> DataFrame:
    """Rows with all their ``reasons``: parse failures or hard-invalid codes."""
    return rows.withColumn(
        "reasons", F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(hard_price_codes())
    )


def process(store: Store, stage_id: str, rows: DataFrame, inventory: DataFrame) -> Outcome:
    """Split quarantined rows, collapse equal copies, reject conflicting files.

    `rows` must be a written table: it is read several times. The key groups are
    staged too, so that rows are shuffled by key once for all that follows.
    """
    good = rows.filter(F.size("reasons") == 0)
    groups = store.stage(
        stage_id,
        "groups",
        key_groups(
            good,
            ["relative_path", "trading_date"],
            PRICE_OBSERVATION,
            F.col("source_line"),
            ["source_key", "source_line", *PRICE_OBSERVATION],
        ),
    )
    rejected_files = batch_conflicts(groups, ["relative_path"])
    return Outcome(
        rows,
        groups,
        rejected_files,
        accepted(groups, ["relative_path"]),
        price_drafts(rows, groups, inventory),
    )


def price_drafts(rows: DataFrame, groups: DataFrame, inventory: DataFrame) -> DataFrame:
    """Incidents of the second pass and the ticker warnings of the first."""
    invalid = draft(
        rows.filter(F.size("reasons") > 0),
        "hard_invalid_record",
        "error",
        F.struct("reasons", "cells"),
        source_key=F.col("source_key"),
        trading_date=F.col("trading_date"),
        relative_path=F.col("relative_path"),
        source_line=F.col("source_line"),
    )
    # Lines of conflicting keys only, gathered per file. A file is already the
    # largest unit one task reads.
    conflicting = (
        rows.filter(F.size("reasons") == 0)
        .join(
            groups.filter("conflict").select("relative_path", "trading_date"),
            ["relative_path", "trading_date"],
            "left_semi",
        )
        .groupBy("relative_path", "source_key", "trading_date")
        .agg(F.array_sort(F.collect_list("source_line")).alias("lines"))
        .groupBy("relative_path", "source_key")
        .agg(
            F.array_sort(
                F.collect_list(F.struct(F.col("trading_date").cast("string").alias("date"), "lines"))
            ).alias("conflicting_lines_by_date")
        )
    )
    conflicts = draft(
        conflicting,
        "conflicting_duplicate_in_snapshot",
        "error",
        F.struct(F.map_from_entries("conflicting_lines_by_date").alias("conflicting_lines_by_date")),
        source_key=F.col("source_key"),
        relative_path=F.col("relative_path"),
    )
    mismatched = draft(
        inventory.filter(F.size("ticker_mismatch_values") > 0),
        KEY_FLAGS[0],
        "warning",
        F.struct("source_key", F.col("ticker_mismatch_values").alias("raw_ticker_values")),
        source_key=F.col("source_key"),
        relative_path=F.col("relative_path"),
    )
    return invalid.unionByName(conflicts).unionByName(mismatched)


def file_outcomes(outcome: Outcome) -> DataFrame:
    """Per file: rows seen, rejected, collapsed and accepted, and whether it is refused.

    A refused file has conflicting copies of a key; all its rows are rejected.
    """
    seen = outcome.rows.groupBy("relative_path").agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(F.size("reasons") > 0).alias("invalid")
    )
    kept = outcome.groups.groupBy("relative_path").agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum(F.col("copies") - 1).alias("copies"),
        F.max("conflict").alias("conflict"),
    )
    refused = F.coalesce("conflict", F.lit(False))
    none = F.lit(0).cast("bigint")
    return seen.join(kept, "relative_path", "left").select(
        "relative_path",
        "seen",
        refused.alias("refused"),
        F.when(refused, F.col("seen")).otherwise(F.col("invalid")).alias("rejected"),
        F.when(refused, none).otherwise(F.coalesce("copies", none)).alias("collapsed"),
        F.when(refused, none).otherwise(F.coalesce("keys", none)).alias("accepted"),
    )


def file_totals(files: DataFrame) -> dict[str, int]:
    """Sums over `file_outcomes`: rows seen and accepted, files refused."""
    row = files.agg(
        F.sum("seen").alias("seen"),
        F.sum("accepted").alias("accepted"),
        F.count_if("refused").alias("refused"),
    ).first()
    return {k: v or 0 for k, v in row.asDict().items()}


def lost_rows(files: DataFrame) -> DataFrame:
    """``(outcome, rows)`` of the rows that reach no comparison."""
    return files.select(
        F.explode(
            F.array(
                F.struct(F.lit("rows_rejected").alias("outcome"), F.col("rejected").alias("rows")),
                F.struct(F.lit("rows_collapsed_duplicates").alias("outcome"), F.col("collapsed").alias("rows")),
            )
        ).alias("o")
    ).select("o.*")


#: Names of the outcomes of a comparison with the stored table.
COMPARED = {NEW: "rows_inserted", UNCHANGED: "rows_unchanged", CONFLICT: "rows_conflicted"}


def compared_rows(classified: DataFrame) -> DataFrame:
    """``(outcome, rows)`` of the rows that were compared."""
    names = F.create_map(*[F.lit(x) for pair in COMPARED.items() for x in pair])
    return classified.groupBy(names[F.col("outcome")].alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


def staged_rows(store: Store, prepared: Prepared, stage_id: str) -> DataFrame:
    """All data lines of the snapshot, parsed, judged and written to staging.

    Files are hashed again from the bytes that are parsed; changed files are fatal, and so
    is a source whose prices are not raw: adjusted ones must never meet the stored rows.
    """
    if prepared.source.basis != RAW:
        raise StructuralError(f"prices are {prepared.source.basis}; only raw prices are loaded")
    rows = store.stage(
        stage_id,
        "rows",
        quarantine(prepared.source.rows(prepared.read())),
    )
    changed = changed_files(rows, prepared.inventory)
    if not changed.isEmpty():
        paths = [r[0] for r in changed.select("relative_path").orderBy("relative_path").limit(5).collect()]
        raise StructuralError(f"files changed since they were inventoried: {paths}")
    return rows


def _rejected_keys(outcome: Outcome) -> list[str]:
    """Keys of rejected files: one short text per rejected file, for the report."""
    keys = outcome.groups.join(outcome.rejected_files, "relative_path", "left_semi")
    return sorted(r[0] for r in keys.select("source_key").distinct().collect())


def _stats(accepted_rows: DataFrame) -> dict[str, Any]:
    s = observation_stats(accepted_rows).first()
    return {
        "status_counts": {r[0]: r[1] for r in status_counts(accepted_rows).collect()},
        "flag_counts": {r[0]: r[1] for r in flag_counts(accepted_rows).orderBy("flag").collect()},
        "missing_open": s["missing_open"],
        "zero_volume": s["zero_volume"],
        "date_range": [str(d) if d else None for d in (s["first_date"], s["last_date"])],
    }


def dry_run(store: Store, prepared: Prepared) -> dict[str, Any]:
    """What a load into empty tables would do; only staging is written, and removed again."""
    with staging(store, "dry-run") as stage_id:
        rows = staged_rows(store, prepared, stage_id)
        outcome = process(store, stage_id, rows, prepared.inventory)
        files = store.stage(stage_id, "files", file_outcomes(outcome))
        totals = file_totals(files)
        inserted = store.spark.range(1).select(
            F.lit("rows_inserted").alias("outcome"), F.lit(totals["accepted"]).cast("bigint").alias("rows")
        )
        counted = balance(outcome_rows(inserted, lost_rows(files))).first().asDict()
        accounted = counted.pop("rows_accounted")
        stock = prepared.inventory.filter("role = 'stock'").count()
        return {
            "mode": "dry_run",
            "identity": prepared.described(),
            "counters_consistent": accounted == totals["seen"],
            "counters": {
                "rows_seen": totals["seen"],
                **counted,
                "files_processed": stock,
                "files_failed": totals["refused"],
                "securities_created": stock,
                "securities_resolved": stock,
                "incidents_created": outcome.drafts.select("fingerprint").distinct().count(),
            },
            "observations": _stats(outcome.accepted),
            "rejected_security_batches": _rejected_keys(outcome),
        }


def dry_run_incidents(outcome: Outcome) -> DataFrame:
    """Incident listing of a dry run, as a table."""
    return outcome.drafts.select(
        "incident_type", "severity", "source_key", "relative_path", "source_line", "fingerprint"
    ).dropDuplicates(["fingerprint"])


# --------------------------------------------------------------------- securities


def resolve_securities(
    keys: DataFrame, known: DataFrame, newest_stored: DataFrame, first_id: int
) -> DataFrame:
    """Security id per key, with ``created`` and ``renamed`` marks.

    New keys get ids in key order. A known security takes the snapshot's name only
    when the snapshot is newer than its stored rows.
    """
    linked = keys.join(known.select("source_key", "security_id"), "source_key", "left")
    new = linked.filter("security_id IS NULL").drop("security_id")
    created = with_dense_ids(new, "source_key", "security_id", first_id).withColumns(
        {"created": F.lit(True), "renamed": F.lit(False)}
    )
    newer = F.col("newest_date").isNotNull() & (
        F.col("stored_date").isNull() | (F.col("newest_date") > F.col("stored_date"))
    )
    existing = (
        linked.filter("security_id IS NOT NULL")
        .join(newest_stored, "security_id", "left")
        .withColumns({"created": F.lit(False), "renamed": newer})
        .drop("stored_date")
    )
    return created.unionByName(existing)


def newest_dates(prices: DataFrame) -> DataFrame:
    """Latest stored date per security."""
    return prices.groupBy("security_id").agg(F.max("trading_date").alias("stored_date"))


def _publish_securities(
    store: Store, publication: Publication, prepared: Prepared, resolved: DataFrame
) -> None:
    version = F.lit(time.time_ns()).cast("bigint")
    changed = resolved.filter("created OR renamed").select(
        "security_id",
        F.col("source_key").alias("ticker"),
        F.col("newest_name").alias("name"),
        F.lit("IDR").alias("currency"),
        F.lit("development").alias("identity_kind"),
        version.alias("version"),
    )
    flagged = F.size("ticker_mismatch_values") > 0
    stored = store.current("security_source_keys", ["source_id", "source_key"])
    mine = stored.filter(F.col("source_id") == prepared.source.source_id).select(
        "source_key", "first_seen_snapshot_id", F.col("quality_flags").alias("old_flags")
    )
    old = F.coalesce("old_flags", F.array().cast("array<string>"))
    keys = (
        resolved.join(mine, "source_key", "left")
        .filter(
            F.col("created") | (flagged & ~F.array_contains(old, KEY_FLAGS[0]))
        )
        .select(
            F.lit(prepared.source.source_id).alias("source_id"),
            "source_key",
            "security_id",
            F.coalesce("first_seen_snapshot_id", F.lit(prepared.snapshot_id)).alias(
                "first_seen_snapshot_id"
            ),
            F.when(flagged, merge_flag(old, KEY_FLAGS[0])).otherwise(old).alias("quality_flags"),
            version.alias("version"),
        )
    )
    publication.append("securities", changed)
    publication.append("security_source_keys", keys)


# --------------------------------------------------------------------------- load


def load_prices(store: Store, prepared: Prepared, *, confirm_revision: str) -> dict[str, Any]:
    """Load a prepared snapshot; returns the run's summary.

    Everything is decided on staged copies. Securities, incidents, prices and the run's
    success then appear together, by one publication; a failed load leaves its run marked
    and nothing else. A rerun finds what is stored and adds only what is missing. Of two
    loads at the same time the one that publishes later fails, as its decisions are stale.
    """
    confirm(prepared, confirm_revision)
    run = register(store, prepared)
    try:
        return _load(store, prepared, run)
    except Exception as exc:
        mark_failed(store, prepared, run, exc)
        raise LoadFailed(f"ingestion run {run.run_id} failed: {exc}") from exc
    finally:
        store.clear(run.run_id)


#: Tables that a load reads to decide what it adds to them.
DECIDED_BY = ("daily_prices", "securities", "security_source_keys", "data_quality_incidents")


def _load(store: Store, prepared: Prepared, run: Run) -> dict[str, Any]:
    publication = store.begin()
    source_id = prepared.source.source_id
    prices = store.read("daily_prices").filter(F.col("source_id") == source_id)
    stock = prepared.inventory.filter("role = 'stock'")
    known = store.current("security_source_keys", ["source_id", "source_key"]).filter(
        F.col("source_id") == source_id
    )
    last_id = store.read("securities").agg(F.max("security_id")).first()[0] or 0
    resolved = store.stage(
        run.run_id,
        "securities",
        resolve_securities(
            stock.select("source_key", "newest_name", "newest_date", "ticker_mismatch_values"),
            known,
            newest_dates(prices),
            last_id,
        ),
    )
    rows = staged_rows(store, prepared, run.run_id)
    outcome = process(store, run.run_id, rows, prepared.inventory)
    # Stored rows outside the snapshot's dates cannot match; their files are pruned.
    span = outcome.rows.agg(F.min("trading_date"), F.max("trading_date")).first()
    overlapping = prices.filter(F.col("trading_date").between(F.lit(span[0]), F.lit(span[1])))
    incoming = (
        outcome.accepted.join(resolved.select("source_key", "security_id"), "source_key")
        .join(run.files.select("relative_path", "file_id"), "relative_path")
        .withColumn("source_id", F.lit(source_id))
    )
    classified = store.stage(
        run.run_id,
        "classified",
        classify(
            incoming,
            overlapping,
            PRICE_KEY,
            PRICE_OBSERVATION,
            [*PRICE_PROVENANCE, "ingestion_run_id"],
        ).select(
            *PRICE_KEY,
            "source_key",
            "relative_path",
            *PRICE_PROVENANCE,
            "outcome",
            # Unchanged rows keep only their key: nothing more is needed of them.
            *[F.when(F.col("outcome") != UNCHANGED, F.col(c)).alias(c) for c in PRICE_OBSERVATION],
            F.when(F.col("outcome") == CONFLICT, F.col("stored")).alias("stored"),
            F.when(F.col("outcome") == CONFLICT, F.col("stored_provenance")).alias(
                "stored_provenance"
            ),
        ),
    )
    if not duplicate_keys(classified, PRICE_KEY).isEmpty():
        raise StructuralError("duplicate keys reached staging")
    files = store.stage(run.run_id, "files", file_outcomes(outcome))
    totals = file_totals(files)
    counters = balanced(outcome_rows(compared_rows(classified), lost_rows(files)), totals["seen"])
    counters |= {
        "files_processed": stock.count(),
        "files_failed": totals["refused"],
        "securities_created": resolved.filter("created").count(),
        "securities_resolved": resolved.count(),
    }
    drafts = outcome.drafts.unionByName(conflict_drafts(classified.filter(F.col("outcome") == CONFLICT)))
    mismatch = mismatch_drafts(prepared, run)
    if mismatch is not None:
        drafts = drafts.unionByName(mismatch)
    with publication:
        _publish_securities(store, publication, prepared, resolved)
        counters["incidents_created"] = append_incidents(
            store, publication, drafts, source_id, run.run_id, resolved, run.files
        )
        publication.append(
            "daily_prices",
            classified.filter(F.col("outcome") == NEW)
            .withColumn("ingestion_run_id", F.lit(run.run_id))
            .sortWithinPartitions("security_id", "trading_date"),
        )
        written = publication.written("daily_prices").count()
        if written != counters["rows_inserted"]:
            raise RuntimeError(f"{written} rows were written, {counters['rows_inserted']} are new")
        summary = {
            "mode": "load",
            "identity": prepared.described(),
            "observations_accepted": _stats(outcome.accepted),
            "rejected_security_batches": _rejected_keys(outcome),
            "run_id": run.run_id,
            "counters": counters,
        }
        publication.append_rows("ingestion_runs", [run_row(prepared, run, "succeeded", counters, summary)])
        publication.publish(unchanged=DECIDED_BY)
    return summary


def conflict_drafts(conflicts: DataFrame) -> DataFrame:
    """Incidents for rows that differ from the stored row, with both versions."""
    stored = F.struct(*[F.col(f"stored.{c}").cast("string").alias(c) for c in PRICE_OBSERVATION])
    return draft(
        conflicts,
        "conflicting_observation",
        "error",
        F.struct(
            stored.alias("stored"),
            as_text(*PRICE_OBSERVATION).alias("incoming"),
            F.struct(
                *[F.col(f"stored_provenance.{c}") for c in (*PRICE_PROVENANCE, "ingestion_run_id")]
            ).alias("stored_provenance"),
            F.struct(*PRICE_PROVENANCE).alias("incoming_provenance"),
        ),
        source_key=F.col("source_key"),
        trading_date=F.col("trading_date"),
        relative_path=F.col("relative_path"),
        source_line=F.col("source_line"),
        # The same differing values are one incident, whichever snapshot has them.
        identity=F.struct(
            F.lit("conflicting_observation").alias("type"),
            *PRICE_KEY,
            as_text(*PRICE_OBSERVATION).alias("incoming"),
        ),
    )
