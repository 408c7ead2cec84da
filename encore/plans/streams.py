"""Streaming forms run over the given tables.

Each function streams a base table with Spark's file source
(``trigger(availableNow=True)``: everything present, then stop), runs the
streaming job, writes its output under the shared checkpoint folder, and
returns it read back as a batch DataFrame. Changelogs run over several
micro-batches, the query being stopped and started again between them. A fresh
output and checkpoint folder per run means a full re-read, like a reset stream
application.

Outputs have the same columns as the batch forms, so the batch forms' oracle
SQL checks them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.plans import jobs as J
from encore.session import checkpoint_dir
from encore.sources import domain
from encore.sources.tables import read_table
from encore.operators.keyed import latest_by_key
from encore.streaming import jobs as SJ
from encore.streaming import sinks
from encore.streaming.carried import in_batches
from encore.streaming.files import file_system


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A base table as a file-source stream (same schema as the batch read)."""
    sch = read_table(spark, sf_dir, name).schema
    base = sf_dir.rstrip("/")
    r = spark.readStream.schema(sch).option("basePath", base)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{base}/{name}[.]parquet")


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a streaming DataFrame to completion into a parquet sink; read it back."""
    spark = df.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/encore-streams/{name}-{uuid.uuid4().hex}"
    q = (df.writeStream.format("parquet").outputMode("append").queryName(f"{name}_{uuid.uuid4().hex[:8]}")
           .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


BATCHES = 3


def stretch(time_col: str, df: DataFrame, batches: int) -> Column:
    """0, 1, ... : which of ``batches`` equal stretches of ``time_col``, over the times of ``df``, a row is in."""
    at = F.unix_micros(time_col) if df.schema[time_col].dataType.typeName() == "timestamp" else F.col(time_col)
    span = df.select(F.struct(F.min(at).alias("least"), F.max(at).alias("most"))).scalar()
    width = (span["most"] - span["least"] + 1)
    return F.least(F.floor((at - span["least"]) * batches / width), F.lit(batches - 1)).cast("int")


def run_in_batches(spark: SparkSession, name: str, rows: DataFrame, time_col: str, job, windows=None, batches: int = BATCHES,
                   times: DataFrame | None = None) -> DataFrame:
    """Stream ``rows`` as ``batches`` micro-batches, in the order of ``time_col``, through a changelog job.

    The stretches are added to the source's folder one by one, and the query is
    started anew after each: it goes on from its checkpoint, and the job's
    totals are carried from batch to batch. ``times`` holds all times of
    ``rows``, maybe more, where they come from fewer tables than the rows.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/encore-streams/{name}-{uuid.uuid4().hex}"
    return stream_in_batches(spark, root, rows, time_col, job, windows, batches, times)


def stream_in_batches(spark: SparkSession, root: str, rows: DataFrame, time_col: str, job, windows=None, batches: int = BATCHES,
                      times: DataFrame | None = None) -> DataFrame:
    staged = rows.withColumn("part", stretch(time_col, rows if times is None else times, batches))
    staged.write.options(**sinks.COMPRESSED).partitionBy("part").parquet(f"{root}/staged")
    for part in batch_parts(spark, f"{root}/staged"):
        publish(spark, f"{root}/staged/part={part}", f"{root}/in/part={part}")
        source = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        q = sinks.start_batches(source, f"stream_{uuid.uuid4().hex[:8]}",
                                in_batches(root, job, windows), mode="append", trigger={"availableNow": True},
                                checkpoint=f"{root}/checkpoint")
        q.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def batch_parts(spark: SparkSession, path: str) -> list[int]:
    """The stretches that have rows, in order."""
    fs, p = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("part=") and n.split("=", 1)[1].isdigit())


def publish(spark: SparkSession, folder: str, to: str) -> None:
    """Hand a written folder on to a source, as a whole and without another copy."""
    fs, p = file_system(spark, folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"cannot move {folder} to {to}")


def stream_customer_stream_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    listens = domain.listen(spark, sf_dir).select("customerid", "id", "streamtime", "pos")
    return run_in_batches(spark, "p8", listens, "pos", SJ.customer_stream_count_changelog)


def _tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.ticket(spark, sf_dir, with_customer=False)


def stream_artist_ticket_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_in_batches(spark, "p9", _tickets(spark, sf_dir), "arrival", SJ.artist_ticket_count_changelog(domain.event(spark, sf_dir)))


def _arrivals(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """When tickets arrive, without looking up their customers."""
    return _tickets(spark, sf_dir).select(F.col("arrival").alias(name))


def _conversion_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.listen(spark, sf_dir).select(F.col("streamtime").alias("time")).unionByName(_arrivals(spark, sf_dir, "time"))


def stream_purchase_event_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_in_batches(spark, "p2", domain.ticket(spark, sf_dir), "arrival", SJ.purchase_event_ticket(domain.event(spark, sf_dir)),
                          times=_arrivals(spark, sf_dir, "arrival"))


def stream_purchase_event_ticket_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 over tickets and an event table that changes between and within the batches."""
    records = J.ticket_and_event_records(domain.ticket(spark, sf_dir), domain.event_changes(spark, sf_dir))
    times = _arrivals(spark, sf_dir, "t").unionByName(domain.event_changes(spark, sf_dir).select(F.col("updated").alias("t")))
    return run_in_batches(spark, "p2-asof", records, "t", SJ.purchase_event_ticket_asof, times=times)


#: Micro-batches of the windowed stream, so that most of its windows close on the way.
WINDOW_BATCHES = 20


def stream_windowed_counts_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5a by carried totals over many batches, each window's totals being deleted when it has closed."""
    listens = domain.listen(spark, sf_dir).select("artistid", "customerid", "streamtime", "pos")
    job = SJ.windowed_counts_changelog(J.QUERY_WINDOW_SECONDS, J.GRACE_SECONDS)
    out = run_in_batches(spark, "p5a-retained", listens, "pos", job, SJ.window_state(J.QUERY_WINDOW_SECONDS, J.GRACE_SECONDS), WINDOW_BATCHES)
    last = out.groupBy("artistid", "customerid", "window_start").agg(F.max("n").alias("n"))
    end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(J.QUERY_WINDOW_SECONDS))
    return last.select("artistid", "customerid", "window_start", end.alias("window_end"), "n")


def stream_partition_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5a with a stream time per source partition, over batches."""
    listens = domain.listen_partitioned(spark, sf_dir).select("artistid", "customerid", "streamtime", "pos", "partition")
    job = SJ.windowed_counts_changelog(J.QUERY_WINDOW_SECONDS, J.GRACE_SECONDS, "partition")
    out = run_in_batches(spark, "p5a-partitions", listens, "pos", job)
    last = out.groupBy("artistid", "customerid", "window_start").agg(F.max("n").alias("n"))
    end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(J.QUERY_WINDOW_SECONDS))
    return last.select("artistid", "customerid", "window_start", end.alias("window_end"), "n")


def stream_customer_conversion_tally_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_in_batches(spark, "p3", J.conversion_events(spark, sf_dir), "time", SJ.conversion_tally,
                          times=_conversion_times(spark, sf_dir))


def stream_customer_conversion_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last tally."""
    return stream_customer_conversion_tally_changelog(spark, sf_dir).groupBy("key").agg(F.max("value").alias("value"))


def stream_customer_match_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_in_batches(spark, "p3-match", J.conversion_events(spark, sf_dir), "time", SJ.customer_match_changelog,
                          times=_conversion_times(spark, sf_dir))


def stream_artist_rank_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    listens = domain.listen(spark, sf_dir).select("customerid", "artistid", "id", "pos")
    return run_in_batches(spark, "ranks", listens, "pos", SJ.artist_rank_changelog)


def stream_top_customer_artists_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    listens = domain.listen(spark, sf_dir).select("customerid", "artistid", "id", "pos")
    return J.flat_top(run_in_batches(spark, "p1", listens, "pos", SJ.top_customer_artists_changelog))


def stream_top_customer_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row per customer of the changelog."""
    listens = domain.listen(spark, sf_dir).select("customerid", "artistid", "id", "pos")
    out = run_in_batches(spark, "p1", listens, "pos", SJ.top_customer_artists_changelog)
    last = out.groupBy("customerid").agg(F.max_by("top", "pos").alias("top"))
    return last.select("customerid", F.posexplode("top").alias("i", "a")).select(
        "customerid", (F.col("i") + 1).cast("bigint").alias("rank"), "a.artistid", "a.n")


def stream_thank_you_top_streamer_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    listens = domain.listen(spark, sf_dir).select("artistid", "customerid", "streamtime", "pos")
    job = SJ.top_streamers(domain.artist(spark, sf_dir), domain.customer(spark, sf_dir), J.QUERY_WINDOW_SECONDS, J.GRACE_SECONDS)
    return run_in_batches(spark, "p5", listens, "pos", job, SJ.window_state(J.QUERY_WINDOW_SECONDS, J.GRACE_SECONDS))


def stream_thank_you_top_streamer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last published best per artist."""
    out = stream_thank_you_top_streamer_changelog(spark, sf_dir)
    columns = [c for c in out.columns if c not in ("pos", "artistId")]
    last = out.groupBy("artistId").agg(F.max_by(F.struct(*columns), "pos").alias("m"))
    return last.select("artistId", "m.*")


def run_updates_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run an update-mode streaming aggregate; each micro-batch's updated rows
    go to their own ``batch_id`` partition (idempotent on replay)."""
    spark = df.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/encore-streams/{name}-{uuid.uuid4().hex}"
    q = sinks.start_batches(df, f"{name}_{uuid.uuid4().hex[:8]}",
                            lambda b, i: sinks.write_batch(b, f"{root}/out", i), mode="update",
                            trigger={"availableNow": True}, checkpoint=f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def stream_windowed_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5a on a stream: built-in windowed count with a watermark of the grace,
    update mode; the current count of a window is its latest update."""
    listens = domain.listen_from(table_stream(spark, sf_dir, "events"), domain.artist_count(spark, sf_dir))
    counts = SJ.windowed_stream_counts(listens, J.QUERY_WINDOW_SECONDS, J.GRACE_SECONDS)
    updates = run_updates_to_table(counts, "p5a")
    cur = latest_by_key(updates, ["artistid", "customerid", "window_start"], [F.col("batch_id")])
    return cur.select("artistid", "customerid", "window_start", "window_end", "n")


def stream_global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12-R15 on streams: running totals of customers, listens, events and
    tickets in one complete-mode aggregate; the latest version is current."""
    totals = SJ.global_totals({
        "customers": table_stream(spark, sf_dir, "customer"),
        "streams": table_stream(spark, sf_dir, "events"),
        "events": table_stream(spark, sf_dir, "part"),
        "tickets": table_stream(spark, sf_dir, "lineitem"),
    })
    spark_ = totals.sparkSession
    root = f"{checkpoint_dir(spark_).rstrip('/')}/encore-streams/totals-{uuid.uuid4().hex}"
    q = sinks.start_batches(totals, f"totals_{uuid.uuid4().hex[:8]}",
                            lambda b, i: sinks.write_batch(b, f"{root}/out", i), mode="complete",
                            trigger={"availableNow": True}, checkpoint=f"{root}/checkpoint")
    q.awaitTermination()
    return sinks.read_latest_batch(spark, f"{root}/out")


def stream_artist_revenue_leader_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = SJ.revenue_leader(domain.event(spark, sf_dir), domain.artist(spark, sf_dir))
    return run_in_batches(spark, "p4", _tickets(spark, sf_dir), "arrival", job)


def stream_target_customer_filter_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = domain.customer_from(table_stream(spark, sf_dir, "customer"))
    legacy = domain.customer_legacy_from(table_stream(spark, sf_dir, "supplier"))
    return run_to_table(SJ.target_customers(cur, legacy), "p6b")


def stream_address_split_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = domain.address_from(table_stream(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"),
                            read_table(spark, sf_dir, "region"))
    return run_to_table(SJ.addresses_by_state(a, J.PRIORITY_STATE_TESTDATA), "p7b")


# Streaming key -> batch key whose oracle SQL checks it.
QUERIES = {
    "stream_top_customer_artists": (stream_top_customer_artists, "top_customer_artists"),
    "stream_top_customer_artists_changelog": (stream_top_customer_artists_changelog, "top_customer_artists_changelog"),
    "stream_customer_conversion_tally_changelog": (stream_customer_conversion_tally_changelog, "customer_conversion_tally_changelog"),
    "stream_customer_match_changelog": (stream_customer_match_changelog, "customer_match_changelog"),
    "stream_artist_rank_changelog": (stream_artist_rank_changelog, "artist_rank_changelog"),
    "stream_thank_you_top_streamer_changelog": (stream_thank_you_top_streamer_changelog, "thank_you_top_streamer_changelog"),
    "stream_purchase_event_ticket": (stream_purchase_event_ticket, "purchase_event_ticket"),
    "stream_purchase_event_ticket_asof": (stream_purchase_event_ticket_asof, "purchase_event_ticket_asof"),
    "stream_windowed_counts_retained": (stream_windowed_counts_retained, "windowed_stream_counts"),
    "stream_partition_late_counts": (stream_partition_late_counts, "partition_late_stream_counts"),
    "stream_customer_conversion_tally": (stream_customer_conversion_tally, "customer_conversion_tally"),
    "stream_thank_you_top_streamer": (stream_thank_you_top_streamer, "thank_you_top_streamer"),
    "stream_artist_revenue_leader_changelog": (stream_artist_revenue_leader_changelog,
                                               "artist_revenue_leader_changelog"),
    "stream_windowed_stream_counts": (stream_windowed_stream_counts, "windowed_stream_counts"),
    "stream_customer_stream_count_changelog": (stream_customer_stream_count_changelog,
                                               "customer_stream_count_changelog"),
    "stream_artist_ticket_count_changelog": (stream_artist_ticket_count_changelog, "artist_ticket_count_changelog"),
    "stream_target_customer_filter_merged": (stream_target_customer_filter_merged, "target_customer_filter_merged"),
    "stream_global_totals": (stream_global_totals, None),
    "stream_address_split_priority": (stream_address_split_priority, "address_split_priority"),
}
