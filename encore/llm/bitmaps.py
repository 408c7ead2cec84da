"""Bloom filters as DataFrames: bits are set by a grouped ``bit_or`` and tested by plain column expressions.

A filter is one row with an array of 64-bit words; a query embeds it as a
scalar subquery, so that neither building nor testing needs a join or Python.
The number of bits is an argument that callers bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import cut

#: Most bits of one filter: 16 MB. It is sent to every executor.
MAX_BITS = 1 << 27


def positions(key: Column, bits: int, hashes: int, seed: int = 0) -> list[Column]:
    """The bit numbers of a key."""
    return [F.pmod(F.xxhash64(F.lit(1000 * seed + j), key), F.lit(bits).cast("bigint")) for j in range(hashes)]


def bitmap(bit_numbers: DataFrame, bits: int, name: str) -> DataFrame:
    """The filter, from a DataFrame with one column ``bit`` of bit numbers (repeated ones do no harm)."""
    spark = bit_numbers.sparkSession
    words = bits // 64 + 1
    word = bit_numbers.select(F.expr("bit div 64").alias("w"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("b"))
    empty = spark.range(words).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("b"))
    dense = word.unionByName(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    packed = dense.agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("x"))
    return cut(packed.select(F.transform("x", lambda x: x["b"]).alias("words")), name)


def keys_bitmap(keys: DataFrame, key: str, bits: int, hashes: int, seed: int, name: str) -> DataFrame:
    """The filter of all values of a column."""
    return bitmap(keys.select(F.explode(F.array(*positions(F.col(key), bits, hashes, seed))).alias("bit")), bits, name)


def may_contain(filter_: DataFrame, key: Column, bits: int, hashes: int, seed: int = 0) -> Column:
    """Whether all bits of a key are set."""
    words = filter_.scalar()
    tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1
             for p in positions(key, bits, hashes, seed)]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out
