"""Counters of the most frequent items per group, in bounded memory.

An exact counter map grows with the number of distinct items of a group. Here
each group keeps a frequent-items sketch of at most ``tracked`` items (Spark's
``approx_top_k`` aggregates): when it is full, the smaller counters are lowered
together and those at zero are dropped. Sketches merge, so partial ones are
built before the shuffle, and those of several batches can be stored and
combined. A count is never too low and at most ``error`` too high, and an item
that is missing has at most ``2 * error`` occurrences. As long as a group has
at most ``tracked`` items its counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items that a group's sketch holds.
TRACKED = 1024


def slots(tracked: int) -> int:
    """Places of a sketch's table: the least power of two that ``tracked`` items fill to three quarters at most."""
    return 1 << max(3, (-(-4 * tracked // 3) - 1).bit_length())


def counters(rows: DataFrame, keys: list[str], item: str, tracked: int = TRACKED) -> DataFrame:
    """``keys, rows, sketch``: the occurrences of non-null items per group and their sketch."""
    sketch = F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("sketch")
    return rows.where(F.col(item).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), sketch)


def combined_counters(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Several sketches per group as one."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.expr("approx_top_k_combine(sketch)").alias("sketch"))


def error_bound(rows: Column, tracked: int) -> Column:
    """By how much a count can be too high: 3.5 / slots of a group's occurrences, the sketch's stated bound."""
    return F.floor(F.lit(3.5) * rows / F.lit(slots(tracked))).cast("bigint")


def frequent(sketches: DataFrame, keys: list[str], item: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """``keys, item, n, error``: up to ``k`` items per group with the greatest counts, each with its bound."""
    top = F.explode(F.expr(f"approx_top_k_estimate(sketch, {k})")).alias("top")
    found = sketches.select(*keys, "rows", top)
    return found.select(*keys, F.col("top.item").alias(item), F.col("top.count").alias("n"),
                        error_bound(F.col("rows"), tracked).alias("error"))
