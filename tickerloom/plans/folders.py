"""Files on the cluster's file system that the driver looks at itself: few and small."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _open(spark, path)
    return fs.exists(where)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme."""
    where, fs = _open(spark, path)
    return fs.makeQualified(where).toString().rstrip("/")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    where, fs = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _open(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Let a file of that name appear whole, in one rename; false if there is one already."""
    jvm = spark.sparkContext._jvm
    made, fs = _open(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(made)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        made.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    choice = spark.sparkContext._gateway.new_array(rename, 1)
    choice[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(made), fs.makeQualified(_open(spark, path)[0]), choice)
    except Exception as exc:
        fs.delete(made, False)
        if "FileAlreadyExistsException" in str(exc):
            return False
        raise
    return True


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Let Hadoop remove a folder, which must exist, when Spark ends."""
    where, fs = _open(spark, path)
    fs.deleteOnExit(where)


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _open(spark, path)
    fs.delete(where, True)
