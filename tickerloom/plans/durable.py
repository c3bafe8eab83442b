"""Reliable intermediate results in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tickerloom.plans import folders

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in for it only when Spark runs in one process.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tickerloom-")
    return _LOCAL[app]


def written(df: DataFrame) -> DataFrame:
    """`df` computed once as compressed Parquet, of which later steps read the columns they need.

    Hadoop removes it when Spark ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    folders.remove_at_end(spark, path)
    return spark.read.schema(schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Compute `df` once and cut its lineage; the copy survives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
        # Spark's own subfolder of this application.
        folders.remove_at_end(spark, spark.sparkContext.getCheckpointDir())
    return df.checkpoint()
