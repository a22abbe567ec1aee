"""Small side files (manifests, commit records), written from the driver to any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole or not at all; False when it exists already."""
    fs, target = _path(spark, path)
    if fs.exists(target):
        return False
    _, draft = _path(spark, f"{target.getParent()}/.{target.getName()}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return bool(fs.rename(draft, target))


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _path(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
