"""Idempotent load: compare incoming rows with the stored table, never overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.sizes import joined_in_tasks

NEW, UNCHANGED, CONFLICT = "new", "unchanged", "conflict"


def classify(
    incoming: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    observation: Sequence[str],
    provenance: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Incoming rows with an ``outcome`` and, for matches, the stored values.

    Rows are compared as NULL-safe structs, so 1.0 and 1.0000 are equal and two
    NULLs are equal. Provenance is carried along but never compared. Keys are
    unique on both sides, so no key can gather rows. Where the `rows` of the larger side
    are known, the join has the tasks that they ask for.
    """
    known = stored.select(
        *keys,
        F.struct(*[F.col(c) for c in observation]).alias("stored"),
        F.struct(F.lit(True).alias("found"), *[F.col(c) for c in provenance]).alias(
            "stored_provenance"
        ),
    )
    obs = F.struct(*[F.col(c) for c in observation])
    outcome = (
        F.when(F.col("stored_provenance").isNull(), NEW)
        .when(obs.eqNullSafe(F.col("stored")), UNCHANGED)
        .otherwise(CONFLICT)
    )
    if rows is None:
        both = incoming.join(known, list(keys), "left")
    else:
        both = joined_in_tasks(incoming, known, keys, "left", rows)
    return both.withColumn("outcome", outcome)


def outcome_counts(classified: DataFrame) -> DataFrame:
    """One row with the number of new, unchanged and conflicting rows."""
    return classified.agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (NEW, UNCHANGED, CONFLICT)]
    )


def only_new(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti")
