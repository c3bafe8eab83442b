"""Dense surrogate ids in key order without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.plans.durable import durable


def with_dense_ids(df: DataFrame, order: str, name: str, start: int) -> DataFrame:
    """Number rows ``start + 1, start + 2, …`` by the unique column `order`.

    Rows are range-partitioned by `order` and numbered inside each partition; the
    offset of a partition is the row count of those before it. The partitioned
    rows are checkpointed first, because sampled range borders could move when a
    lost task is run again. The offsets have one row per partition.
    """
    ranged = durable(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    numbered = ranged.withColumn("_rn", F.row_number().over(inside))
    # One offset row per partition: bounded by the number of shuffle partitions.
    return numbered.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_rn") + F.lit(start)).cast("bigint").alias(name)
    )
