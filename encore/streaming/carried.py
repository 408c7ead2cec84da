"""Running aggregates over micro-batches: batch plans with totals carried from one batch to the next.

A job is written once, over a ``Scan``: a function that adds running
aggregates to rows. ``prefix_scan`` is the scan over a whole table. ``Carried``
is the scan over one micro-batch: the prefix scan inside the batch, combined
with each key's totals of all batches before. Both run as Spark plans, with a
hot key's rows spread over cells, so no such key is one task or one Python worker.
A batch counts its rows by slots of a hash of the key first. Keys of slots with
few rows are not hot: they have no cells, whose totals would be as many as the
rows, and their rows are shuffled once, for the window and the join alike.

The totals are a table in buckets, of a hash of the key or, for totals of time
windows, one per window. A batch finds which buckets its keys are in as it
counts its rows, writes its own totals as increments, and reads those buckets alone.
Every ``COMPACT_EVERY`` batches the buckets with increments are added up into
bases of their own; increments and bases that no replay can ask for any more
are deleted, and so are, with every batch, the buckets of closed windows. A
batch that is replayed overwrites its own increments and reads only those
before it. In a chain of scans each one's rows are stored once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.operators.running import HOT_ROWS, Spec, _total, combined, hot_keys, prefix_scan, quiet_scan
from encore.streaming.files import batch_ids, expire, file_system
from encore.streaming.sinks import COMPRESSED, write_batch

#: ``scan(name, rows, keys, order, time_col, specs)``: rows with one column per spec. ``name`` tells the scans of a job apart.
Scan = Callable[[str, DataFrame, list[str], list[Column], str, list[Spec]], DataFrame]

COMPACT_EVERY = 16
#: Buckets of totals whose key has no window.
BUCKETS = 32
#: Slots of a hash of the key by which the rows of a batch are counted: of all of it, and of each window.
SLOTS, WINDOW_SLOTS = 1 << 14, 1 << 6


def whole_table(cell: int | None = None, hot: dict[str, DataFrame] | None = None) -> Scan:
    """The scan over a static table. ``hot[name]`` are the keys of a scan that have cells (``hot_keys``), by default all."""
    return lambda name, rows, keys, order, time_col, specs: prefix_scan(rows, keys, order, time_col, specs, cell=cell,
                                                                        hot=(hot or {}).get(name))


@dataclass(frozen=True)
class Window:
    """Totals that have a window in their key: the column with its start, its width, and how long after its end the
    stream time can still be when a record counts in it."""
    column: str
    seconds: int
    grace_seconds: int


def _buckets(spark: SparkSession, path: str) -> list[int]:
    """The buckets that one batch of a table has."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("bucket="))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


class Carried:
    """The scan of one micro-batch. Write what it gives, then ``commit``."""

    def __init__(self, path: str, batch_id: int, windows: dict[str, Window] | None = None, cell: int | None = None):
        """``windows[name]`` tells the scans whose keys have a time window."""
        self.path, self.batch_id, self.windows, self.cell = path, batch_id, windows or {}, cell
        self.added: list[tuple[str, list[str], list[Spec], T.StructType]] = []
        self.read: dict[str, list[int]] = {}

    def bucket(self, name: str, keys: list[str]) -> Column:
        if name in self.windows:
            w = self.windows[name]
            return F.floor(F.unix_seconds(F.col(w.column).cast("timestamp")) / w.seconds).cast("bigint")
        return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("bigint") if keys else F.lit(0).cast("bigint")

    def totals_before(self, spark: SparkSession, name: str, keys: list[str], specs: list[Spec], schema: T.StructType,
                      buckets: list[int], batch_id: int) -> DataFrame | None:
        """The totals of all batches before ``batch_id`` in some buckets."""
        base, steps, wanted = f"{self.path}/{name}/base", f"{self.path}/{name}/steps", set(buckets)
        newest: dict[int, int] = {}
        for version in batch_ids(spark, base):
            if version < batch_id:
                newest |= {b: version for b in _buckets(spark, f"{base}/batch_id={version}") if b in wanted}
        paths = [f"{base}/batch_id={version}/bucket={b}" for b, version in newest.items()]
        for step in batch_ids(spark, steps):
            if step < batch_id and any(newest.get(b, -1) < step for b in wanted):
                paths += [f"{steps}/batch_id={step}/bucket={b}" for b in _buckets(spark, f"{steps}/batch_id={step}")
                          if b in wanted and newest.get(b, -1) < step]
        if not paths:
            return None
        return spark.read.schema(schema).parquet(*paths).groupBy(*keys).agg(*[_merged(s).alias(f"t_{s.out}") for s in specs])

    def spread(self, rows: DataFrame, name: str, keys: list[str]) -> tuple[list[int], DataFrame | None]:
        """The buckets of the keys of a batch, and its hot keys, if it has any: those with more than ``HOT_ROWS`` rows,
        counted among the slots that have so many."""
        if not keys:
            return [0], None
        slot = F.pmod(F.xxhash64(*keys), F.lit(WINDOW_SLOTS if name in self.windows else SLOTS))
        placed = rows.select(*keys, self.bucket(name, keys).alias("__bucket"), slot.alias("__slot"))
        slots = placed.groupBy("__bucket", "__slot").agg(F.count(F.lit(1)).alias("__rows"))
        found = slots.groupBy("__bucket").agg(F.max("__rows").alias("most")).collect()
        hot = None
        if any(r["most"] > HOT_ROWS for r in found):
            full = slots.where(F.col("__rows") > HOT_ROWS).drop("__rows")
            hot = hot_keys(placed.join(F.broadcast(full), ["__bucket", "__slot"], "left_semi"), keys, HOT_ROWS)
            listed = hot.collect()
            hot = rows.sparkSession.createDataFrame(listed, hot.schema).select(*keys) if listed else None
        return sorted(r["__bucket"] for r in found), hot

    def __call__(self, name: str, rows: DataFrame, keys: list[str], order: list[Column], time_col: str,
                 specs: list[Spec]) -> DataFrame:
        spark, root = rows.sparkSession, f"{self.path}/{name}"
        for k in keys:
            rows = rows.where(F.col(k).isNotNull())
        if self.added:  # what an earlier scan gave
            rows.write.mode("overwrite").options(**COMPRESSED).parquet(f"{root}/rows/batch_id={self.batch_id}")
            rows = spark.read.schema(rows.schema).parquet(f"{root}/rows/batch_id={self.batch_id}")
        buckets, hot = self.spread(rows, name, keys)
        self.read[name] = buckets
        kept = _kept_once(specs)
        stored = [s for s in specs if kept[s.out] is s]
        counting = rows
        if all(s.value is not None for s in specs):  # rows without any value add nothing to a total
            counting = rows.where(reduce(or_, [s.column().isNotNull() for s in stored]))
        aggregates = [_kept(s, order).alias(f"t_{s.out}") for s in stored] + [F.count(F.lit(1)).alias("rows")]
        totals = counting.groupBy(*keys).agg(*aggregates)
        if keys and hot is None and any(isinstance(f.dataType, T.StructType) for f in totals.schema.fields[len(keys):]):
            # Records that are made of a row's columns are wider than the row, and of a few rows per key not fewer.
            totals = counting.repartition(*keys).groupBy(*keys).agg(*aggregates)
        totals = totals.where("rows > 0").drop("rows")
        self.added.append((name, keys, stored, totals.schema))
        own = f"{root}/steps/batch_id={self.batch_id}"
        totals.withColumn("bucket", self.bucket(name, keys)).write.mode("overwrite").options(**COMPRESSED).partitionBy("bucket").parquet(own)
        here = [replace(s, out=f"h_{s.out}") for s in specs]
        before = self.totals_before(spark, name, keys, stored, totals.schema, buckets, self.batch_id)

        def with_before(scanned: DataFrame, before: DataFrame | None) -> DataFrame:
            if before is None:
                return scanned.select(*rows.columns, *[F.col(f"h_{s.out}").alias(s.out) for s in specs])
            joined = scanned.join(before, keys, "left") if keys else scanned
            total = {s.out: F.col(f"t_{s.out}") if keys else before.select(f"t_{s.out}").scalar() for s in stored}
            value = {s.out: total[kept[s.out].out]["value"] if s.op == "last" else total[kept[s.out].out] for s in specs}
            return joined.select(*rows.columns, *[combined(s.op, F.col(f"h_{s.out}"), value[s.out]).alias(s.out) for s in specs])

        if not keys:
            return with_before(prefix_scan(rows, keys, order, time_col, here, cell=self.cell), before)
        if hot is None:
            return with_before(quiet_scan(rows, keys, order, here), before)
        hot = F.broadcast(hot)
        busy = prefix_scan(rows.join(hot, keys, "left_semi").select(*rows.columns), keys, order, time_col, here, cell=self.cell)
        quiet = quiet_scan(rows.join(hot, keys, "left_anti").select(*rows.columns), keys, order, here)
        few = None if before is None else F.broadcast(before.join(hot, keys, "left_semi"))
        return with_before(quiet, before).unionByName(with_before(busy, few))

    def commit(self, spark: SparkSession) -> None:
        """Delete what is no longer needed, and from time to time add up the increments."""
        for name, keys, specs, schema in self.added:
            root = f"{self.path}/{name}"
            _delete(spark, f"{root}/rows/batch_id={self.batch_id}")
            if name in self.windows:
                self._expire_windows(spark, root, self.windows[name])
            if self.batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                self._compact(spark, root, name, keys, specs, schema)

    def _compact(self, spark: SparkSession, root: str, name: str, keys: list[str], specs: list[Spec], schema: T.StructType) -> None:
        base, steps, last = f"{root}/base", f"{root}/steps", self.batch_id - COMPACT_EVERY
        fresh = {b for step in batch_ids(spark, steps) if last < step <= self.batch_id for b in _buckets(spark, f"{steps}/batch_id={step}")}
        whole = self.totals_before(spark, name, keys, specs, schema, sorted(fresh), self.batch_id + 1)
        if whole is not None:
            whole = whole.withColumn("bucket", self.bucket(name, keys))
            (whole.repartition("bucket") if keys else whole).write.mode("overwrite").options(**COMPRESSED).partitionBy("bucket").parquet(
                f"{base}/batch_id={self.batch_id}")
        # A replay of this batch starts from the newest base before it, and from the increments after that.
        expire(spark, steps, last + 1)
        later: set[int] = set()
        for version in sorted((v for v in batch_ids(spark, base) if v < self.batch_id), reverse=True):
            there = set(_buckets(spark, f"{base}/batch_id={version}"))
            for b in there & later:
                _delete(spark, f"{base}/batch_id={version}/bucket={b}")
            if there <= later:
                _delete(spark, f"{base}/batch_id={version}")
            later |= there

    def _expire_windows(self, spark: SparkSession, root: str, window: Window) -> None:
        """Delete the windows that had closed when this batch began: the stream time was then at least the newest window
        that had been counted."""
        folders = [f"{root}/{kind}/batch_id={b}" for kind in ("base", "steps") for b in batch_ids(spark, f"{root}/{kind}")
                   if b < self.batch_id]
        found = {folder: _buckets(spark, folder) for folder in folders}
        newest = max((b for bs in found.values() for b in bs), default=None)
        for folder, buckets in found.items():
            for b in buckets:
                if (b + 1) * window.seconds + window.grace_seconds <= newest * window.seconds:
                    _delete(spark, f"{folder}/bucket={b}")


def _kept_once(specs: list[Spec]) -> dict[str, Spec]:
    """For each spec's name the one whose total it uses: the first with the same aggregate of the same column."""
    first: dict[tuple, Spec] = {}
    return {s.out: first.setdefault((s.op, s.value if s.value is None or isinstance(s.value, str) else id(s.value)), s) for s in specs}


def _kept(spec: Spec, order: list[Column]) -> Column:
    """A batch's total as it is stored: the last value has its place with it."""
    if spec.op != "last":
        return _total(spec, order)
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return F.max_by(F.struct(place.alias("at"), spec.column().alias("value")), F.when(spec.column().isNotNull(), place))


def _merged(spec: Spec) -> Column:
    total = F.col(f"t_{spec.out}")
    if spec.op == "last":
        return F.max_by(total, total["at"])
    return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[spec.op](total)


def in_batches(path: str, job: Callable[[DataFrame, Scan], DataFrame], windows: dict[str, Window] | None = None,
               cell: int | None = None):
    """``foreachBatch`` function: run ``job(rows, scan)`` on each micro-batch and write its result to
    ``path/out/batch_id=N``; the totals that ``scan`` carries are below ``path/state``."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            scan = Carried(f"{path}/state", batch_id, windows, cell)
            write_batch(job(batch, scan), f"{path}/out", batch_id)
            scan.commit(batch.sparkSession)
        finally:
            batch.unpersist()
    return fn
