"""Folders of tables that are written batch by batch, as ``batch_id=N``."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """The batches that a ``batch_id``-partitioned table has, ascending; none if there is no such folder.
    Any other failure to read the folder is an error."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))


def expire(spark: SparkSession, path: str, before: int) -> None:
    """Delete the batches before ``before``."""
    fs, _ = file_system(spark, path)
    for b in batch_ids(spark, path):
        if b < before:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={b}"), True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark has committed the table in a folder."""
    fs, _ = file_system(spark, path)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
