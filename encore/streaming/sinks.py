"""Streaming sinks.

Checkpoints live under the shared ``spark.checkpoint.dir`` (never a
machine-local folder): a restarted or re-scheduled query resumes from its
committed offsets and state.

Second stages that Spark cannot run inside one streaming query (an arg-max
over a windowed aggregate, a global leader) run in ``foreachBatch`` and merge
into a versioned parquet table: each batch writes ``batch_id=N`` with
overwrite, so a replayed batch replaces its own output (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from encore.session import checkpoint_dir
from encore.streaming.files import batch_ids, is_complete


#: Tables that a stream writes for itself and its results.
COMPRESSED = {"compression": "zstd"}


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/encore-streams/{name}"


# Fixed value: the commit interval of the stream jobs, used as the default
# micro-batch trigger of long-running queries.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}


def start(df: DataFrame, name: str, mode: str = "append", sink: str = "memory", path: str | None = None,
          trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start ``df`` into a sink: ``memory`` (query name = ``name``), ``parquet``
    (at ``path``), ``console`` or ``noop``. ``trigger`` defaults to a micro-batch
    every 10 seconds; ``{"availableNow": True}`` processes what is there and stops."""
    spark = df.sparkSession
    w = (df.writeStream.outputMode(mode).queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, name)))
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    if sink == "parquet":
        return w.format("parquet").option("path", path).start()
    return w.format(sink).start()


def start_batches(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None], mode: str = "update",
                  trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch (exactly-once with an
    idempotent ``fn``)."""
    spark = df.sparkSession
    w = (df.writeStream.outputMode(mode).queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, name))
         .foreachBatch(fn))
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    return w.start()


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent per-batch write: the batch's own partition is overwritten."""
    (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").options(**COMPRESSED)
          .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """The newest ``batch_id`` version (for complete-mode results)."""
    v = spark.read.parquet(path)
    return v.where(F.col("batch_id") == v.agg(F.max("batch_id")).scalar()).drop("batch_id")


# ---------------------------------------------------------------- observation (the reference's per-record log)

def observed(df: DataFrame, name: str, *metrics) -> DataFrame:
    """Attach named metrics to a stream (default: the record count), reported
    with every micro-batch's progress instead of one log line per record."""
    ms = metrics or (F.count(F.lit(1)).alias("records"),)
    return df.observe(name, *ms)


def progress_logger(log=print):
    """A ``StreamingQueryListener`` that logs each batch's input rows, rate and
    observed metrics; register with ``spark.streams.addListener``."""
    from pyspark.sql.streaming import StreamingQueryListener

    class _Progress(StreamingQueryListener):
        def onQueryStarted(self, event):
            log(f"stream {event.name or event.id} started")

        def onQueryProgress(self, event):
            p = event.progress
            obs = {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}
            log(f"stream {p.name or p.id} batch {p.batchId}: {p.numInputRows} rows, "
                f"{p.processedRowsPerSecond:.0f} rows/s, metrics {obs}")

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            log(f"stream {event.id} terminated" + (f": {event.exception}" if event.exception else ""))

    return _Progress()


# ---------------------------------------------------------------- record shapes and multi-sink writes

#: Times keep their microseconds (by default JSON has milliseconds).
MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_records(df: DataFrame, key: str) -> DataFrame:
    """``(key string, value string)`` with the row as a JSON document, the shape a
    Kafka sink writes; longs stay longs (``from_json`` with the schema reads
    them back exactly)."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns), MICROSECONDS).alias("value"))


def from_records(records: DataFrame, schema) -> DataFrame:
    """Parse ``value`` JSON documents with a fixed schema (once, at the source)."""
    return records.select("key", F.from_json("value", schema, MICROSECONDS).alias("v")).select("key", "v.*")


def start_kafka(df: DataFrame, name: str, bootstrap: str, topic: str, key: str,
                trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Write JSON records to a Kafka topic (Spark's Kafka sink; its package must
    be on the classpath -- it is not in this image)."""
    spark = df.sparkSession
    w = (to_records(df, key).writeStream.format("kafka").queryName(name)
         .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, name)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def split_writer(paths: dict[str, str], route_col: str = "sink", manifest: str | None = None):
    """``foreachBatch`` function writing each route's rows to its own parquet
    path (one sink per branch). The batch is persisted once and each branch is
    written into its ``batch_id`` partition, so a replayed batch is idempotent.

    With ``manifest``, a folder, the branches appear together: a batch's entry
    there, with the number of rows of each branch, is written when all of them
    are, and ``read_branch`` takes the batches that have one.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for route, path in paths.items():
                write_batch(batch.where(F.col(route_col) == route).drop(route_col), path, batch_id)
            if manifest:
                counts = batch.groupBy(F.col(route_col).alias("route")).agg(F.count(F.lit(1)).alias("rows"))
                counts.coalesce(1).write.mode("overwrite").parquet(f"{manifest}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return fn


def read_branch(spark: SparkSession, path: str, manifest: str, schema: T.StructType) -> DataFrame:
    """The rows of one branch, of those batches alone whose branches are all written."""
    there = set(batch_ids(spark, path))  # a branch without rows in a batch has no folder for it
    done = [b for b in batch_ids(spark, manifest) if b in there and is_complete(spark, f"{manifest}/batch_id={b}")]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/batch_id={b}" for b in done])
