"""Replicated tables that change while a stream runs: a new version is published as a whole, and each micro-batch joins
to the newest one there is. Which versions a batch used is stored, so that a batch that is replayed uses the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from encore.streaming.carried import Carried, Scan
from encore.streaming.files import batch_ids, is_complete


@dataclass(frozen=True)
class Published:
    """A table at ``path`` in versions ``batch_id=0``, ``batch_id=1``, ..., each of which Spark commits as a whole."""
    path: str
    schema: T.StructType

    def versions(self, spark: SparkSession) -> list[int]:
        return [v for v in batch_ids(spark, self.path) if is_complete(spark, f"{self.path}/batch_id={v}")]

    def publish(self, rows: DataFrame) -> int:
        """Write the next version; its number. One writer at a time."""
        version = max(self.versions(rows.sparkSession), default=-1) + 1
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch_id={version}")
        return version

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        """One version; no rows for -1, before the first."""
        if version < 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={version}")


def refreshing(tables: dict[str, Published], job: Callable[..., Callable[[DataFrame, Scan], DataFrame]]):
    """A job for ``in_batches`` whose static tables are read anew in every micro-batch: ``job(**tables)`` gives the job
    over one set of versions."""
    def run(rows: DataFrame, scan: Carried) -> DataFrame:
        used = _used(rows.sparkSession, f"{scan.path}/lookups/batch_id={scan.batch_id}", tables)
        return job(**{name: t.read(rows.sparkSession, used[name]) for name, t in tables.items()})(rows, scan)
    return run


def _used(spark: SparkSession, path: str, tables: dict[str, Published]) -> dict[str, int]:
    """The versions of a batch: those of its first run, or the newest."""
    if not is_complete(spark, path):
        newest = [(name, max(t.versions(spark), default=-1)) for name, t in tables.items()]
        spark.createDataFrame(newest, "name string, version int").coalesce(1).write.mode("overwrite").parquet(path)
    return {r["name"]: r["version"] for r in spark.read.parquet(path).collect()}
