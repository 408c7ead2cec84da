"""Stream-table enrichment: join each stream row to a keyed table's value.

Two modes:
* ``latest`` -- the table's current value (``latest_by_key``), an equi inner
  join. Right when the table is fully loaded before the stream is processed
  (a replicated table), and the default for batch jobs.
* ``asof`` -- the value as of the stream row's arrival: the table version with
  the greatest table position at or before the stream row's position in a
  shared arrival order. A stream row that arrives before any table row for its
  key is dropped (inner), and a tombstone deletes the key from then on.

The as-of form is a tagged union of both sides and a running "last non-null"
per key (``prefix_scan``), so a hot key is bucketed like any running
aggregate. There is no range or cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.keyed import latest_by_key
from encore.operators.running import Spec, prefix_scan


def enrich_latest(stream: DataFrame, table: DataFrame, stream_key: str, table_key: str,
                  table_cols: list[str], table_order=None, tombstone: Column | None = None,
                  prefix: str = "") -> DataFrame:
    """Inner join of stream rows to the table's latest row per key."""
    t = table
    if table_order is not None:
        t = latest_by_key(table, table_key, table_order, tombstone)
    t = t.select(F.col(table_key).alias("__tk"), *[F.col(c).alias(prefix + c) for c in table_cols])
    return stream.join(t, stream[stream_key] == t["__tk"], "inner").drop("__tk")


def enrich_asof(stream: DataFrame, table: DataFrame, stream_key: str, table_key: str,
                stream_time: str, table_time: str, stream_tie: list[str], table_tie: list[str],
                table_cols: list[str], tombstone: Column | None = None, prefix: str = "",
                table_first: bool = True, cell: int | None = None, hot: DataFrame | None = None) -> DataFrame:
    """As-of inner join; see the module text. ``hot`` are the stream's keys that have cells (``hot_keys``), by default all.

    Order is ``(time, side, tie...)``; with ``table_first`` a table row and a
    stream row at the same time see the table row first.
    """
    records = tagged(stream, table, stream_key, table_key, stream_time, table_time, stream_tie, table_tie, table_cols, tombstone,
                     table_first)

    def scan(_, rows, keys, order, time, specs):
        return prefix_scan(rows, keys, order, time, specs, cell=cell, hot=None if hot is None else hot.withColumnRenamed(stream_key, "k"))

    return as_of(records, table_cols, scan, stream_key, stream_time, stream_tie, prefix)


def tagged(stream: DataFrame, table: DataFrame, stream_key: str, table_key: str, stream_time: str, table_time: str,
           stream_tie: list[str], table_tie: list[str], table_cols: list[str], tombstone: Column | None = None,
           table_first: bool = True) -> DataFrame:
    """Both sides of an as-of join as records of one stream: ``k, t, side`` and either ``srow`` or ``trow``.

    What ``k`` and ``t`` hold is not in ``srow`` again, and a tie of the stream
    is made of ``srow`` where it is needed (``as_of``).
    """
    s_cols = [c for c in stream.columns if c != stream_key and not _same_time(stream, c, stream_time)]
    tside, sside = (0, 1) if table_first else (1, 0)
    dead = tombstone if tombstone is not None else F.lit(False)
    n = max(len(stream_tie), len(table_tie))  # the shorter tie is padded, so that both sides compare
    ties = [(F.col(table_tie[i]) if i < len(table_tie) else F.lit(None)).cast("string").alias(f"t{i}") for i in range(n)]
    trow = F.struct(dead.alias("dead"), *[F.col(c) for c in table_cols], F.struct(*ties).alias("__tie"))
    s = stream.select(
        F.col(stream_key).alias("k"), F.col(stream_time).cast("timestamp").alias("t"), F.lit(sside).alias("side"),
        F.struct(*s_cols).alias("srow"), F.lit(None).cast(table.select(trow).schema[0].dataType).alias("trow"))
    t = table.select(
        F.col(table_key).alias("k"), F.col(table_time).cast("timestamp").alias("t"), F.lit(tside).alias("side"),
        F.lit(None).cast(stream.select(F.struct(*s_cols)).schema[0].dataType).alias("srow"), trow.alias("trow"))
    return s.unionByName(t).where(F.col("k").isNotNull())


def _same_time(stream: DataFrame, column: str, stream_time: str) -> bool:
    return column == stream_time and stream.schema[column].dataType.typeName() == "timestamp"


def as_of(records: DataFrame, table_cols: list[str], scan, stream_key: str, stream_time: str, stream_tie: list[str],
          prefix: str = "") -> DataFrame:
    """The stream rows among tagged records, each with the table's value at its place. ``scan`` adds the running
    aggregate: over a whole table, or over a micro-batch with what is carried from the batches before."""
    inside = records.schema["srow"].dataType.names
    n = len(records.schema["trow"].dataType["__tie"].dataType.names)

    def own(c: str) -> Column:
        return F.col("srow")[c] if c in inside else F.col("k" if c == stream_key else "t")

    ties = [(own(stream_tie[i]) if i < len(stream_tie) else F.lit(None)).cast("string").alias(f"t{i}") for i in range(n)]
    tie = F.when(F.col("srow").isNotNull(), F.struct(*ties)).otherwise(F.col("trow")["__tie"])
    scanned = scan("table", records, ["k"], [F.col("t"), F.col("side"), tie], "t", [Spec("cur", "last", "trow")])
    out = scanned.where(F.col("srow").isNotNull() & F.col("cur").isNotNull() & ~F.col("cur.dead"))
    placed = [F.col("k").alias(stream_key)] + ([] if stream_time in inside else [F.col("t").alias(stream_time)])
    return out.select("srow.*", *placed, *[F.col(f"cur.{c}").alias(prefix + c) for c in table_cols])
