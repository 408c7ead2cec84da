"""Tumbling windows with the grace rule for late records.

Windows are epoch-aligned ``[start, start + size)`` like ``F.window``;
computed by integer arithmetic on microseconds so the batch form needs no
window struct.

Late rule: a record is dropped when its window has closed, i.e. when
``window_end <= stream_time - grace``, where ``stream_time`` is the greatest
record time seen so far (in arrival order) within the source partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.running import Spec, prefix_scan


def window_start(time_col, size_seconds: int) -> Column:
    us = F.unix_micros(F.col(time_col).cast("timestamp") if isinstance(time_col, str) else time_col)
    w = size_seconds * 1_000_000
    return F.timestamp_micros(F.floor(us / F.lit(w)).cast("bigint") * F.lit(w))


def with_window(df: DataFrame, time_col: str, size_seconds: int) -> DataFrame:
    start = window_start(time_col, size_seconds)
    return (df.withColumn("window_start", start)
              .withColumn("window_end", F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                               F.lit(size_seconds))))


def drop_late_records(df: DataFrame, time_col: str, arrival_order: list[Column], arrival_time: str,
                      size_seconds: int, grace_seconds: int, partition_cols: list[str] | None = None,
                      cell: int | None = None) -> DataFrame:
    """Keep only records whose window is still open on arrival.

    ``arrival_order`` is the total arrival order (leading ``arrival_time``);
    stream time is a running max over it, computed with ``prefix_scan`` so
    the global running value is computed in cells, not sorted in one task.
    """
    scanned = prefix_scan(df, partition_cols or [], arrival_order, arrival_time,
                          [Spec("__stream_time", "max", F.col(time_col).cast("timestamp"))], cell=cell)
    return still_open(scanned, time_col, "__stream_time", size_seconds, grace_seconds).drop("__stream_time")


def still_open(df: DataFrame, time_col: str, now: str, size_seconds: int, grace_seconds: int) -> DataFrame:
    """Records whose window has not closed at the stream time ``now``."""
    w = with_window(df, time_col, size_seconds)
    close = F.col(now) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(grace_seconds))
    return w.where(F.col("window_end") > close).drop("window_start", "window_end")


def tumbling_counts(df: DataFrame, keys: list[str], time_col: str, size_seconds: int,
                    last_order: Column | None = None) -> DataFrame:
    """Count per ``(keys, window)``; with ``last_order``, also the order value of
    the window's last record (when the final count was reached)."""
    w = with_window(df, time_col, size_seconds)
    aggs = [F.count(F.lit(1)).alias("n")]
    if last_order is not None:
        aggs.append(F.max(last_order).alias("last_pos"))
    nn = w
    for k in keys:
        nn = nn.where(F.col(k).isNotNull())
    return nn.groupBy(*keys, "window_start", "window_end").agg(*aggs)
