"""Per-key reductions written as aggregates, so Spark combines map-side.

A hot key (a third of all rows, say) collapses to one partial row per map task
before the shuffle; none of these sort a key's rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions import col


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col(c) for c in cs]


def _names(cs) -> list[str]:
    if isinstance(cs, str):
        return [cs]
    return list(cs)


def latest_by_key(df: DataFrame, key, order, tombstone: Column | None = None) -> DataFrame:
    """Latest row per key by ``order`` (a changelog table's current state).

    ``order`` must be a total order (end it with a unique column). Rows where
    ``tombstone`` is true delete the key: a key whose latest row is a tombstone
    is absent from the result. Null keys are dropped, as a keyed table does.
    Implemented as ``max(struct(order..., row))`` so it combines map-side.
    """
    keys = _names(key)
    order_cols = _cols(order)
    cols = df.columns
    marked = df.withColumn("__dead", tombstone if tombstone is not None else F.lit(False))
    packed = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
                      F.struct(*cols, "__dead").alias("__row"))
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    agg = marked.where(cond).groupBy(*keys).agg(F.max(packed).alias("__m"))
    out = agg.select("__m.__row.*")
    return out.where(~F.col("__dead")).select(*cols)


def arg_max_first(df: DataFrame, group, value, order, payload: Sequence[str],
                  value_name: str | None = None) -> DataFrame:
    """Per group, the row with the greatest numeric ``value``; ties go to the
    smallest ``order`` (first to reach it). One aggregate, map-side combined.

    Returns ``group..., value_name, payload...``.
    """
    keys = _names(group)
    v = col(value)
    vname = value_name or (value if isinstance(value, str) else "value")
    order_cols = _cols(order)
    packed = F.struct((-v).alias("__nv"),
                      *[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
                      v.alias("__v"),
                      *[F.col(p).alias(f"__p_{p}") for p in payload])
    base = df.where(v.isNotNull())
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    agg = base.groupBy(*keys).agg(F.min(packed).alias("__m"))
    return agg.select(*keys, F.col("__m.__v").alias(vname),
                      *[F.col(f"__m.__p_{p}").alias(p) for p in payload])


def first_seen(df: DataFrame, key, value, order) -> DataFrame:
    """Distinct ``(key, value)`` with the order of first appearance, i.e. a
    distinct set in first-seen order, kept as rows (never one growing array)."""
    keys = _names(key) + _names(value)
    order_cols = _cols(order)
    o = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order_cols)])
    return df.groupBy(*keys).agg(F.min(o).alias("first_pos"))
