"""Fingerprints and digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_text(columns: Sequence[Column]) -> Column:
    """One unambiguous text per row: fields joined by U+001F, NULL as U+2400."""
    return F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("␀")) for c in columns])


def row_fingerprint(columns: Sequence[Column]) -> Column:
    """SHA-256 of the row text."""
    return F.sha2(row_text(columns), 256)


def multiset_digest(df: DataFrame, columns: Sequence[Column], name: str = "digest") -> DataFrame:
    """One digest for all rows that does not depend on their order.

    The SHA-256 of every row is cut into four 60-bit numbers that are summed
    separately, so partial sums combine on the map side and no row list is built.
    """
    hashed = df.select(row_fingerprint(columns).alias("h"))
    limbs = [
        F.sum(F.conv(F.substring("h", 1 + 16 * i, 15), 16, 10).cast("decimal(20,0)")).cast(
            "decimal(38,0)"
        )
        for i in range(4)
    ]
    return hashed.agg(F.count(F.lit(1)).alias("rows"), *[s.alias(f"s{i}") for i, s in enumerate(limbs)]).select(
        F.col("rows").cast("bigint").alias("rows"),
        F.sha2(
            F.concat_ws(
                ":",
                F.col("rows").cast("string"),
                *[F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("string") for i in range(4)],
            ),
            256,
        ).alias(name),
    )
