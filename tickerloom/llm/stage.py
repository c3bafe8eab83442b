"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tickerloom.plans.durable import shared_folder


def staged(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet and read back; Hadoop removes it when Spark ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(schema).parquet(path)
