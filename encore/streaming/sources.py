"""Streaming sources: entity records as Structured Streaming DataFrames.

Records are JSON documents (or parquet rows) with the entity's fixed schema
(``encore.schemas``) plus an arrival-order column ``pos`` (bigint, unique per
source). The state functions sort each group's rows by ``pos`` inside a
micro-batch; across micro-batches order is the source's order.

``kafka_stream`` reads a topic through Spark's Kafka source when its package
is on the classpath (it is not in this image): the record value is parsed with
``from_json`` once at the source, and ``pos`` holds the record's timestamp,
partition and offset. Jobs that need a number as position get one from
``numbered``, which counts the records in that order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.running import Spec
from encore.schemas import TOPICS, schema
from encore.streaming.carried import Scan


def entity_stream(spark: SparkSession, path: str, entity: str, fmt: str = "json",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream of ``entity`` records (with ``pos``)."""
    r = spark.readStream.schema(schema(entity, with_pos=True)).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def entity_table(spark: SparkSession, path: str, entity: str, fmt: str = "json") -> DataFrame:
    """The same records read as a static table (for stream-static joins)."""
    return spark.read.schema(schema(entity, with_pos=True)).format(fmt).load(path)


def kafka_stream(spark: SparkSession, bootstrap: str, entity: str, starting: str = "earliest",
                 topic: str | None = None, options: dict | None = None) -> DataFrame:
    """Entity records from a Kafka topic: ``key`` plus the parsed value columns,
    and ``pos`` from (timestamp, partition, offset).

    A fresh checkpoint with ``startingOffsets=earliest`` re-reads the topic from
    the start, which is what a reset of the stream application does.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic or TOPICS[entity])
         .option("startingOffsets", starting))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return kafka_records(r.load(), entity)


def kafka_records(raw: DataFrame, entity: str) -> DataFrame:
    """Entity rows from Kafka's columns (``key, value, timestamp, partition, offset``), with ``pos`` and ``deleted``.

    ``pos`` is the struct of timestamp, partition and offset, which orders the
    records of any number of partitions and is unique. A record without a value
    deletes its key: all columns are null but ``id``, which is the key, and
    ``deleted`` is true.
    """
    pos = F.struct("timestamp", "partition", "offset")
    key = F.col("key").cast("string")
    parsed = raw.select(key.alias("key"), F.from_json(F.col("value").cast("string"), schema(entity)).alias("v"), pos.alias("pos"),
                        F.col("value").isNull().alias("deleted"))
    columns = [F.when(F.col("deleted"), F.col("key")).otherwise(F.col(f"v.{f.name}").cast("string")).cast(f.dataType).alias(f.name)
               if f.name == "id" else F.col(f"v.{f.name}").alias(f.name) for f in schema(entity).fields]
    return parsed.select("key", *columns, "pos", "deleted")


def numbered(job: Callable[[DataFrame, Scan], DataFrame]) -> Callable[[DataFrame, Scan], DataFrame]:
    """A changelog job over records of ``kafka_records``: ``pos`` becomes the number of the record in the order of
    timestamp, partition and offset, counted on from the micro-batches before."""
    def run(records: DataFrame, scan: Scan) -> DataFrame:
        flat = records.select([c for c in records.columns if c != "pos"] + ["pos.*"])
        counted = scan("arrival", flat, [], [F.col("timestamp"), F.col("partition"), F.col("offset")], "timestamp", [Spec("pos", "count")])
        return job(counted.drop("timestamp", "partition", "offset"), scan)
    return run
