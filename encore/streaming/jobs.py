"""Streaming forms of the jobs (P1-P11) on Structured Streaming.

Changelogs (one row per record) are the batch jobs over a scan that carries
totals between micro-batches. Snapshots use Spark's built-in streaming
aggregates; second stages that one streaming query cannot hold (arg-max over
an aggregate, the global leader) are ``foreachBatch`` merges into versioned
tables, of which the last few versions are kept.

Stateless jobs (P6, P7, P10, P11) are the batch expressions on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import functions as fx
from encore.operators.enrich import as_of
from encore.operators.keyed import arg_max_first, latest_by_key
from encore.plans import jobs as J
from encore.streaming.carried import Scan, Window, batch_ids, expire
from encore.streaming.sinks import write_batch


def _nn(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def _event_lookup(events: DataFrame) -> DataFrame:
    """Static event table keyed for the stream-static join. When the table is a
    changelog (rows carry ``pos``), only the latest version per id is kept, and
    an event whose latest version is a deletion (``deleted``, or no value at
    all) is left out."""
    if "pos" in events.columns:
        empty = F.coalesce(*[F.col(c).cast("string") for c in ("artistid", "capacity")]).isNull()
        dead = F.coalesce(F.col("deleted"), F.lit(False)) | empty if "deleted" in events.columns else empty
        events = latest_by_key(events, "id", [F.col("pos")], tombstone=dead)
    return events.select(F.col("id").alias("eventid"), "artistid", "capacity")


# ---------------------------------------------------------------- changelogs
#
# One row per input record, exact over micro-batches. Each is the batch job over the scan that carries totals
# (``encore.streaming.carried``); pass it to ``in_batches``, which gives the ``foreachBatch`` function.

def top_customer_artists_changelog(listens: DataFrame, scan: Scan) -> DataFrame:
    """The customer's top artists after every listen."""
    return J.top_customer_artists_changelog_from(listens, scan=scan)


def purchase_event_ticket(events: DataFrame):
    """One confirmation per ticket request (stream-static join to events)."""
    return lambda tickets, scan: J.confirm_tickets(tickets.join(_event_lookup(events), "eventid"), scan)


def conversion_tally(records: DataFrame, scan: Scan) -> DataFrame:
    """The tally after every record that re-emits a true match, over listens and purchases in one stream."""
    return J.conversion_tally_from(records, scan)


def customer_match_changelog(records: DataFrame, scan: Scan) -> DataFrame:
    """P3's join, update by update, with what each update withdraws."""
    return J.match_changelog_from(records, scan)


def artist_rank_changelog(listens: DataFrame, scan: Scan) -> DataFrame:
    """The rank of the listened artist among the customer's after every listen."""
    return J.artist_rank_changelog_from(listens, scan)


def revenue_leader(events: DataFrame, artists: DataFrame):
    """The revenue leader after every ticket with a known event and artist."""
    return lambda tickets, scan: J.revenue_leader_by_scans(_nn(tickets.join(_event_lookup(events), "eventid"), "artistid"), artists, scan)


def top_streamers(artists: DataFrame, customers: DataFrame, size_seconds: int = J.WINDOW_SECONDS, grace_seconds: int = J.GRACE_SECONDS):
    """P5: the artist's best single-window listener after every listen that counts."""
    return lambda listens, scan: J.thank_you_changelog_from(_nn(listens, "artistid", "customerid"), artists, customers,
                                                            size_seconds, grace_seconds, scan)


def customer_stream_count_changelog(listens: DataFrame, scan: Scan) -> DataFrame:
    """P8."""
    return J.customer_stream_count_changelog_from(listens, scan)


def artist_ticket_count_changelog(events: DataFrame):
    """P9."""
    return lambda tickets, scan: J.artist_ticket_count_changelog_from(tickets.join(_event_lookup(events), "eventid"), scan)


def window_state(size_seconds: int, grace_seconds: int) -> dict[str, Window]:
    """For ``in_batches(windows=...)`` of P5a and P5: the totals that lie in a folder per window, deleted when it closes.
    Where source partitions have stream times of their own, ``grace_seconds`` has to cover their lag as well."""
    return {"windows": Window("window_start", size_seconds, grace_seconds)}


def windowed_counts_changelog(size_seconds: int = J.WINDOW_SECONDS, grace_seconds: int = J.GRACE_SECONDS, partition: str | None = None):
    """The count of (artist, customer, window) after every listen that is not late by the stream time, which each
    source ``partition`` carries for itself where that column is named."""
    return lambda listens, scan: J.windowed_counts_changelog_from(_nn(listens, "artistid", "customerid"), size_seconds, grace_seconds,
                                                                  scan, partition)


def purchase_event_ticket_asof(records: DataFrame, scan: Scan) -> DataFrame:
    """P2 over tickets and changes of the event table in one stream (``J.ticket_and_event_records``): the event's last
    value is carried between batches, and a ticket sees it as of its arrival."""
    return J.confirm_tickets(as_of(records, ["capacity"], scan, "eventid", "arrival", ["id", "price"]), scan)


# ---------------------------------------------------------------- snapshots per micro-batch (built-in state)

def customer_stream_count(listens: DataFrame) -> DataFrame:
    """P8 snapshot, ``update`` mode: one row per changed customer per batch."""
    return _nn(listens, "customerid").groupBy("customerid").agg(F.count(F.lit(1)).alias("n"))


def artist_ticket_count(tickets: DataFrame, events: DataFrame) -> DataFrame:
    j = _nn(tickets.join(_event_lookup(events), "eventid"), "artistid")
    return j.groupBy("artistid").agg(F.count(F.lit(1)).alias("n"))


def artist_revenue(tickets: DataFrame, events: DataFrame) -> DataFrame:
    """P4a, ``update`` mode: running revenue per artist (price truncated per
    ticket); ``last_pos`` is the position of the ticket that set the total."""
    j = _nn(tickets.join(_event_lookup(events), "eventid"), "artistid")
    return j.groupBy("artistid").agg(F.sum(F.col("price").cast("bigint")).alias("revenue"),
                                     F.max("pos").alias("last_pos"))


def windowed_stream_counts(listens: DataFrame, size_seconds: int = J.WINDOW_SECONDS,
                           grace_seconds: int = J.GRACE_SECONDS, time_col: str = "streamtime") -> DataFrame:
    """P5a, ``update`` mode: tumbling counts per (artist, customer); records
    behind the watermark (max event time seen minus the grace) are dropped.
    Spark advances the watermark between micro-batches, so within a batch a
    few late records may still count; ``encore.operators.windows`` has the
    exact per-record rule for batch."""
    ts = F.col(time_col).cast("timestamp")
    s = _nn(listens.withColumn("__t", ts), "artistid", "customerid")
    return (s.withWatermark("__t", f"{grace_seconds} seconds")
             .groupBy("artistid", "customerid", F.window("__t", f"{size_seconds} seconds").alias("w"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("last_pos"))
             .select("artistid", "customerid", F.col("w.start").alias("window_start"),
                     F.col("w.end").alias("window_end"), "n", "last_pos"))


def global_totals(streams: dict[str, DataFrame]) -> DataFrame:
    """R12-R15 on streams, ``complete`` (or ``update``) mode: one running count
    per named stream, over a tagged union -- each task counts its share and
    the partial counts are combined, however the data is split."""
    tagged = None
    for name, df in streams.items():
        t = df.select(F.lit(name).alias("metric"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.groupBy("metric").agg(F.count(F.lit(1)).alias("total"))


def top_artists_global(listens: DataFrame, k: int = 3) -> DataFrame:
    """R2 on a stream, ``complete`` mode: the k most streamed artists so far
    (running count per artist; the sort and limit run on the counts)."""
    counts = _nn(listens, "artistid").groupBy("artistid").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "artistid").limit(k)


# ---------------------------------------------------------------- foreachBatch second stages

VERSIONS_KEPT = 8


def _latest_version(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The newest version of a table written before batch ``before``, if there is one."""
    older = [b for b in batch_ids(spark, path) if b < before]
    return spark.read.parquet(f"{path}/batch_id={max(older)}") if older else None


def _write_version(df: DataFrame, path: str, batch_id: int) -> None:
    write_batch(df, path, batch_id)
    expire(df.sparkSession, path, batch_id - VERSIONS_KEPT)


def merge_top_streamers(path: str):
    """P5 second stage over ``windowed_stream_counts`` (update mode): per artist
    the best single-window count so far (first to reach it wins), as a
    versioned table at ``path``. Each batch rewrites the per-artist table, so
    this suits a bounded artist set; ``top_streamers`` gives the same answer in
    increments. Unknown artists and customers are kept: ``published`` leaves them out."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        cand = batch.select("artistid", "customerid", F.col("n").alias("streamCount"), "last_pos")
        prev = _latest_version(batch.sparkSession, path, batch_id)
        if prev is not None:
            cand = cand.unionByName(prev.select(*cand.columns))
        _write_version(arg_max_first(cand, "artistid", "streamCount", [F.col("last_pos")], ["customerid", "last_pos"]), path, batch_id)
    return fn


def published(best: DataFrame, artists: DataFrame, customers: DataFrame) -> DataFrame:
    """Bests of known artists whose customer is known."""
    best = best.join(artists.select(F.col("id").alias("artistid")), "artistid", "left_semi")
    return best.join(customers.select(F.col("id").alias("customerid")), "customerid", "left_semi")


def merge_revenue_leader(path: str, artists: DataFrame):
    """P4 second stage: the revenue leader, replaced only by a strictly greater
    total (a high-water mark), as a versioned table at ``path``."""
    a = artists.select(F.col("id").alias("artistId"), F.struct("id", "name", "genre").alias("artist"))

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cand = (batch.select(F.col("artistid").alias("artistId"), "revenue", "last_pos")
                     .join(a, "artistId"))
        prev = _latest_version(spark, path, batch_id)
        if prev is not None:
            cand = cand.unionByName(prev.select("artistId", "revenue", "last_pos", "artist")
                                        .withColumn("last_pos", F.lit(-1).cast("long")))
        lead = arg_max_first(cand.withColumn("__g", F.lit(fx.LEADER_KEY)), "__g", "revenue",
                             [F.col("last_pos")], ["artistId", "artist", "last_pos"])
        _write_version(lead.select(F.col("__g").alias("key"), "artistId", "artist", "revenue", "last_pos"), path, batch_id)
    return fn


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    v = spark.read.parquet(path)
    return v.where(F.col("batch_id") == v.agg(F.max("batch_id")).scalar()).drop("batch_id")


# ---------------------------------------------------------------- stateless

def target_customers(customers: DataFrame, legacy: DataFrame | None = None) -> DataFrame:
    """1990s birthdays, over the current stream merged with the legacy one."""
    s = customers if legacy is None else customers.unionByName(legacy)
    return J.target_customers_from(s)


def addresses_by_state(addresses: DataFrame, priority_state: str = J.PRIORITY_STATE_DEFAULT) -> DataFrame:
    """``(key=state, value=formatted address, sink)``; write each sink
    with a filter on ``sink`` (or one ``foreachBatch`` that persists the batch)."""
    return J.address_split_from(addresses, priority_state)


def passthrough(df: DataFrame) -> DataFrame:
    """P10: source to sink unchanged."""
    return df


def confirmation_notices(confirmations: DataFrame) -> DataFrame:
    """Notice rows (recipient, subject, body) for each confirmation."""
    return J.notices_from(confirmations)
