"""Duplicates of a key: collapse identical ones, reject conflicting ones.

Most keys have one row. Hashes of the keys, eight bytes a row, are counted first; rows whose
hash occurs once pass as they are, without a shuffle. Only the others are grouped, by
aggregates that combine on the map side (count, minimum, maximum, lowest line), so many
copies of one key never meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.sizes import checked


class ConflictingDuplicates(ValueError):
    """Copies of a key disagree where that is not allowed."""


def key_groups(
    rows: DataFrame,
    keys: Sequence[str],
    observation: Sequence[str],
    order: Column,
    keep: Sequence[str],
) -> DataFrame:
    """One row per key: copy count, whether copies differ, and the first copy.

    The columns `keep` are those of the copy with the lowest `order`. Two copies are equal
    when the smallest and the largest observation are equal. `rows` is read twice, so it
    should be a written table. Keys that share a hash without being equal are grouped
    with the copies, each on its own.
    """
    hashed = rows.withColumn("_key", F.xxhash64(*keys))
    counted = hashed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    repeated = checked(counted.filter("_n > 1").select("_key"))
    single = hashed.join(repeated, "_key", "left_anti").select(
        *keys, F.lit(1).cast("bigint").alias("copies"), F.lit(False).alias("conflict"), *keep
    )
    obs = F.struct(*[F.col(c) for c in observation])
    first = F.min(F.struct(order.alias("_order"), *[F.col(c) for c in keep]))
    several = (
        hashed.join(repeated, "_key", "left_semi")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            (~F.min(obs).eqNullSafe(F.max(obs))).alias("conflict"),
            first.alias("_kept"),
        )
        .select(*keys, "copies", "conflict", *[F.col(f"_kept.{c}").alias(c) for c in keep])
    )
    return single.unionByName(several)


def batch_conflicts(groups: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Batches (files, securities) that hold at least one conflicting key."""
    return groups.filter("conflict").select(*batch).distinct()


def accepted(groups: DataFrame, batch: Sequence[str] | None = None) -> DataFrame:
    """Keys that survive: no conflict, and none in the batch when one is given."""
    clean = groups.filter(~F.col("conflict"))
    if batch is None:
        return clean
    return clean.join(batch_conflicts(groups, batch), list(batch), "left_anti")


def require_no_conflicts(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`groups` unchanged; raises with the five least keys when copies conflict."""
    bad = groups.filter("conflict").select(*keys).orderBy(*keys).limit(5).collect()
    if bad:
        raise ConflictingDuplicates(
            "conflicting duplicate keys, e.g. " + "; ".join(", ".join(map(str, r)) for r in bad)
        )
    return groups


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their number of copies."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
