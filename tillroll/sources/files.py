"""Directory questions, asked through the Hadoop file system so that any lake URI works."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below ``path``; none where it is not there."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def partition_dirs(spark: SparkSession, path: str, column: str) -> set[str]:
    """Names ``column=value`` of the partition directories directly below ``path``."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return set()
    names = (status.getPath().getName() for status in fs.listStatus(hadoop_path))
    return {name for name in names if name.startswith(f"{column}=")}


def drop_partition_dirs(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    for name in names:
        delete(spark, f"{path}/{name}")


def create_whole(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its text or not at all; False where the name is already taken."""
    fs, target = _open(spark, path)
    target = fs.makeQualified(target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    unnamed = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(unnamed, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    keep_existing = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(unnamed, target, keep_existing)
    except Py4JJavaError as failure:
        fs.delete(unnamed, False)
        if "FileAlreadyExistsException" in failure.java_exception.getClass().getName():
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
