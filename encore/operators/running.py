"""Running (prefix) aggregates in arrival order: the per-record changelog.

``prefix_scan`` computes, for every row, aggregates over all rows of its key
that come at or before it in ``order`` -- the batch form of a table that emits
one update per input record.

Scale: a window ``partition by key order by pos`` sorts a key's rows in one
task, and a global running value (no key) sorts *everything* in one task. So
the leading order column is cut into cells of a fixed width, at any input size:
the window runs per ``(key, cell)``, which spreads a hot key over many tasks;
the cells' totals, from a plain hash aggregate, are summed up over the earlier
cells of the key, and the two are combined. A cell's rows depend on the rate
of arrival and the width, not on how long the history is. Without a key all
cells belong together, so their totals are summed up in two steps, within
blocks of cells and over the blocks, and no task orders the totals of all.
With a key, the caller can name the hot keys, counted from its source table by
``hot_keys``: the ``MOST_HOT`` keys with the most rows, of those with more than
``HOT_ROWS``. Only they are cut into cells then; any other key is one cell and
carries nothing. It pays where the source is counted cheaply, as rows that come
from other scans would have to be computed once more.
Nothing is computed while the plan is built, and no statistics are kept.

The rows are shuffled once: the window and the totals read the same exchange.
For that both must read the same columns, so the totals carry a checksum over
all of them, and callers hand in only the columns that they use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions import col

#: Width of a cell: of times in microseconds, of sequence numbers in records. A key has only some of the records, and
#: wide cells leave a quiet key with few totals.
MINUTE, DAY = 60 * 1_000_000, 86_400 * 1_000_000
RECORDS, KEYED_RECORDS = 1 << 12, 1 << 20
#: Cells in a block, where rows have no key.
BLOCK = 1 << 12
#: Rows up to which a key is one cell, and how many keys can have cells of their own.
HOT_ROWS, MOST_HOT = 1 << 20, 1 << 16
#: The cell of a key that is not hot, and that of a hot key's rows without a time, before all others.
QUIET = -(1 << 62)
FIRST = QUIET + 1

OPS = ("count", "sum", "max", "min", "last")


@dataclass(frozen=True)
class Spec:
    """One running aggregate: ``out`` = ``op`` over ``value`` up to the row.

    ``last`` is the last non-null value (like ``last(x, ignorenulls)``). With
    ``before`` the row itself is left out: what there was when it came.
    """
    out: str
    op: str
    value: str | Column | None = None
    before: bool = False

    def __post_init__(self):
        if self.op not in OPS:
            raise ValueError(f"unknown op {self.op}")

    def column(self) -> Column | None:
        return col(self.value) if self.value is not None else None

    @property
    def added(self) -> str:
        """The op that makes one total of several."""
        return "sum" if self.op == "count" else self.op


def _is_time(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))


def cell_of(df: DataFrame, name: str, width: int | None, keyed: bool) -> Column:
    """Number of the cell of a row. Default widths: a day or ``KEYED_RECORDS`` per key, a minute or ``RECORDS`` where rows
    have no key."""
    value = F.unix_micros(F.col(name).cast("timestamp")) if _is_time(df, name) else F.col(name).cast("bigint")
    wide, narrow = (DAY, MINUTE) if _is_time(df, name) else (KEYED_RECORDS, RECORDS)
    width = width or (wide if keyed else narrow)
    return F.floor(value / F.lit(width)).cast("bigint")


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame:
    """The ``most`` keys that have the most rows, of those with more than ``rows``: a key that is not among them has at
    most ``rows`` rows or 1 in ``most`` of all."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)
    return counts.orderBy(F.desc("__n")).limit(most).select(*keys, F.lit(True).alias("__hot"))


def in_cells(df: DataFrame, keys: list[str], time_col: str, width: int | None, hot: DataFrame | None = None) -> DataFrame:
    """``df`` with ``__cell``, shuffled by key and cell. With ``hot`` the other keys are one cell, ``QUIET``."""
    cell = cell_of(df, time_col, width, bool(keys))
    if hot is None:
        return df.withColumn("__cell", cell).repartition(*keys, "__cell")
    marked = df.join(F.broadcast(hot), keys, "left")
    # Never null, or the join's filter on it would come between the shuffle and one of its two readers.
    placed = F.coalesce(F.when(F.col("__hot").isNull(), F.lit(QUIET)).otherwise(cell), F.lit(FIRST))
    return marked.select(*df.columns, placed.alias("__cell")).repartition(*keys, "__cell")


def cell_totals(cells: DataFrame, keys: list[str], aggregates: list[Column], cell: str = "__cell", quiet: bool = False) -> DataFrame:
    """Aggregates per key and cell over all columns of ``cells``, so that they share its exchange. With ``quiet`` some keys
    are one cell: of them there is nothing to carry, and so no total."""
    whole = [F.bit_xor(F.xxhash64(*cells.columns)).alias("__all")]
    kept = "__all is not null"
    if quiet:  # asked of an aggregate, as a filter on the cell itself would go below the exchange
        whole.append(F.max(cell).alias("__last"))
        kept += f" and __last <> {QUIET}"
    return cells.groupBy(*keys, cell).agg(*aggregates, *whole).where(kept).drop("__all", "__last")


def _earlier(totals: DataFrame, keys: list[str], place: str, specs: list[Spec], prefix: str) -> list[Column]:
    """For each spec its total ``__t_`` over the rows with a lower ``place``, as ``prefix`` and its name."""
    w = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return [_running(Spec(s.out, s.added, f"__t_{s.out}"), F.col(f"__t_{s.out}"), w).alias(f"{prefix}{s.out}") for s in specs]


def carried_totals(totals: DataFrame, keys: list[str], specs: list[Spec], block: int = BLOCK) -> DataFrame:
    """Per key and cell what is carried into it: ``__c_`` and the name of each spec, over the earlier cells."""
    if keys:
        return totals.select(*keys, "__cell", *_earlier(totals, keys, "__cell", specs, "__c_"))
    blocks = totals.withColumn("__block", F.floor(F.col("__cell") / F.lit(block))).repartition("__block")
    inside = blocks.select("__block", "__cell", *_earlier(blocks, ["__block"], "__cell", specs, "__i_"))
    merge = {"sum": F.sum, "max": F.max, "min": F.min,
             "last": lambda t: F.max_by(t, F.when(t.isNotNull(), F.col("__cell")))}
    whole = cell_totals(blocks, [], [merge[s.added](F.col(f"__t_{s.out}")).alias(f"__t_{s.out}") for s in specs], "__block")
    outside = whole.select("__block", *_earlier(whole, [], "__block", specs, "__o_"))
    return inside.join(outside, "__block", "left").select("__cell", *[
        combined(s.added, F.col(f"__i_{s.out}"), F.col(f"__o_{s.out}")).alias(f"__c_{s.out}") for s in specs])


def _running(spec: Spec, value: Column | None, w) -> Column:
    if spec.op == "count":
        return F.count(value if value is not None else F.lit(1)).over(w)
    if spec.op == "last":
        return F.last(value, ignorenulls=True).over(w)
    return {"sum": F.sum, "max": F.max, "min": F.min}[spec.op](value).over(w)


def _total(spec: Spec, order: list[Column]) -> Column:
    v = spec.column()
    if spec.op == "count":
        return F.count(v if v is not None else F.lit(1))
    if spec.op == "last":
        place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
        return F.max_by(v, F.when(v.isNotNull(), place))
    return {"sum": F.sum, "max": F.max, "min": F.min}[spec.op](v)


def combined(op: str, here: Column, before: Column) -> Column:
    """The running value from that inside the cell and that carried into it; either may be null."""
    if op == "count":
        return here + F.coalesce(before, F.lit(0))
    if op == "sum":
        return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(here + before)
    if op == "last":
        return F.coalesce(here, before)
    return (F.greatest if op == "max" else F.least)(here, before)


def prefix_scan(df: DataFrame, keys: list[str], order: list[Column], time_col: str, specs: list[Spec],
                cell: int | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Add one column per ``Spec`` holding its running value.

    ``order`` must be a total order whose leading column is ``time_col`` (a
    timestamp or a number), so cells respect it. Rows with a null key have no
    place in a keyed table and are dropped. ``cell`` is the width of a cell,
    and ``hot`` are the keys that have cells (``hot_keys``), by default all.
    """
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    cells = in_cells(rows, keys, time_col, cell, hot)
    part = [*keys, "__cell"]
    w = Window.partitionBy(*part).orderBy(*order)
    upto, before = (w.rowsBetween(Window.unboundedPreceding, last) for last in (Window.currentRow, -1))
    local = cells.select("*", *[_running(s, s.column(), before if s.before else upto).alias(f"__l_{s.out}") for s in specs])
    totals = cell_totals(cells, keys, [_total(s, order).alias(f"__t_{s.out}") for s in specs], quiet=hot is not None)
    joined = local.join(carried_totals(totals, keys, specs), on=part, how="left")
    return joined.select(*df.columns, *[combined(s.op, F.col(f"__l_{s.out}"), F.col(f"__c_{s.out}")).alias(s.out)
                                        for s in specs])


def quiet_scan(df: DataFrame, keys: list[str], order: list[Column], specs: list[Spec]) -> DataFrame:
    """``prefix_scan`` for keys of which none is hot: one window per key, without cells and their totals. The rows stay
    shuffled by the key, so that a join on the key that follows moves none of them, and what the window orders by and
    adds up is made of their columns behind the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    upto, before = (w.rowsBetween(Window.unboundedPreceding, last) for last in (Window.currentRow, -1))
    placed = df.repartition(*keys)
    return placed.select("*", *[_running(s, s.column(), before if s.before else upto).alias(s.out) for s in specs])


def running_count(df: DataFrame, keys: list[str], order: list[Column], time_col: str,
                  out: str = "n", **kw) -> DataFrame:
    return prefix_scan(df, keys, order, time_col, [Spec(out, "count")], **kw)


def running_sum(df: DataFrame, keys: list[str], order: list[Column], time_col: str,
                value, out: str, **kw) -> DataFrame:
    return prefix_scan(df, keys, order, time_col, [Spec(out, "sum", value)], **kw)


def running_leader(df: DataFrame, order: list[Column], time_col: str, value: str, payload: list[str],
                   out: str = "leader", cell: int | None = None) -> DataFrame:
    """Running arg-max in global ``order`` with a strict ``>``: a row sets a
    record when its ``value`` exceeds every earlier row's value; ``out`` is the
    last record at or before the row (``struct(payload..., value)``). Ties keep
    the earlier leader, and the leader is a high-water mark.

    In cells like ``prefix_scan``. Inside a cell, a record beats all earlier
    rows of the cell; the records that also beat the greatest value carried
    into the cell are the true ones. A cell's last record is its first row at
    its greatest value.
    """
    v = F.col(value)
    record = F.struct(*[F.col(p) for p in payload], v.alias(value))
    cells = in_cells(df, [], time_col, cell)
    w = Window.partitionBy("__cell").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cells.withColumn("__before", F.max(v).over(before))
    local = local.withColumn("__record", F.when(v.isNotNull() & (F.col("__before").isNull() | (v > F.col("__before"))), record))
    local = local.withColumn("__here", F.last("__record", ignorenulls=True).over(upto)).drop("__before", "__record")

    place = F.struct((-v).alias("v"), *[c.alias(f"o{i}") for i, c in enumerate(order)])
    totals = cell_totals(cells, [], [F.min_by(record, F.when(v.isNotNull(), place)).alias("__best")])
    earlier = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    best = totals.withColumn("__most", F.max(F.col(f"__best.{value}")).over(earlier))
    own = F.when(F.col("__best").isNotNull() & (F.col("__most").isNull() | (F.col(f"__best.{value}") > F.col("__most"))),
                 F.col("__best"))
    carried = best.withColumn("__own", own).select("__cell", "__most", F.last("__own", ignorenulls=True).over(earlier)
                                                   .alias("__carried"))
    here = F.col("__here")
    leads = here.isNotNull() & (F.col("__most").isNull() | (F.col(f"__here.{value}") > F.col("__most")))
    joined = local.join(carried, "__cell", "left")
    return joined.withColumn(out, F.when(leads, here).otherwise(F.col("__carried"))).select(*df.columns, out)
