"""Small files and folders by Hadoop's file systems, so that any path Spark can read will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _target(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _target(spark, path)
    return system.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, target = _target(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _target(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file, visible only when it is whole: written beside its place (hidden) and renamed."""
    system, target = _target(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.part")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(beside, target):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    system, target = _target(spark, path)
    system.delete(target, True)
