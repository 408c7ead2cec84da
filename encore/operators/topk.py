"""Top-k rows per group, skew-safe.

A plain ``row_number() over (partition by g order by o)`` sorts every row of a
group in one task. With ``salt_buckets > 1`` the ranking is done in two
phases: first within ``(group, salt)`` (a hot group is spread over
``salt_buckets`` tasks, each keeping its own top k), then within the group over
at most ``k * salt_buckets`` survivors. The result is exact: a row in the
global top k is in the top k of its own salt bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group, order: list[Column], k: int,
                    salt_buckets: int = 1, salt: Column | None = None,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``1..k`` within each group by ``order`` (a total order).

    ``salt`` is any column that spreads a group's rows (default: a hash of the
    ordering columns); it does not change the result, only the task layout.
    """
    groups = [group] if isinstance(group, str) else list(group)
    if salt_buckets > 1:
        s = salt if salt is not None else F.xxhash64(*order)
        salted = df.withColumn("__salt", F.pmod(s, F.lit(salt_buckets)))
        w1 = Window.partitionBy(*groups, "__salt").orderBy(*order)
        df = (salted.withColumn("__r1", F.row_number().over(w1))
                    .where(F.col("__r1") <= k).drop("__r1", "__salt"))
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= k)
