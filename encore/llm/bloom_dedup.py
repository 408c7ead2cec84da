"""Exact dedup by two passes with a Bloom filter.

Pass 1 counts the bit positions of all hashes; a filter keeps the positions
that were hit twice or more. Pass 2 tests every row: a text that occurs twice
has all its positions in the filter, so a row that fails the test is unique
and passes straight through. Only the other rows (true repeats and a few false
positives) shuffle, to be grouped by their SHA-256.

The filter is bounded by ``max_bits``. Where a corpus needs more, the hash
space is cut into as many slices, and each slice, stored by itself, gets the
two passes with a filter of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.bitmaps import MAX_BITS, bitmap, may_contain, positions
from encore.llm.common import cut, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_ROW, HASHES = 16, 2


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def repeated_rows(rows: DataFrame, n: int, max_bits: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Split ``rows`` (a stored table with a binary column ``sha``, ``n`` rows) into (certainly unique, the rest)."""
    bits = int(min(max_bits, max(64, BITS_PER_ROW * n)))
    hit = rows.select(F.explode(F.array(*positions(F.col("sha"), bits, HASHES))).alias("bit"))
    twice = hit.groupBy("bit").agg(F.count("*").alias("n")).filter("n > 1").select("bit")
    filter_ = bitmap(twice, bits, f"{name}-twice")
    maybe = may_contain(filter_, F.col("sha"), bits, HASHES)
    return rows.filter(~maybe), rows.filter(maybe)


def dedup_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest ``doc_id`` stays; a null id is
    below all others. Of rows repeated with that id exactly one stays. Null
    text counts as empty; an empty table gives an empty result.
    """
    light = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("sha"))
    # Numbered once and stored: the number tells repeated rows apart, whatever is computed again later.
    light = cut(light.withColumn("rid", F.monotonically_increasing_id()), "dedup-light")
    n = light.count()
    slices = max(1, math.ceil(BITS_PER_ROW * n / max_bits))
    if slices == 1:
        parts = [(light, n)]
    else:
        path = scratch(docs.sparkSession, "dedup-slices")
        sliced = light.withColumn("slice", F.pmod(F.xxhash64(F.lit(-1), "sha"), F.lit(slices)).cast("int"))
        sliced.write.partitionBy("slice").parquet(path)
        stored = docs.sparkSession.read.schema(sliced.schema).parquet(path)
        sizes = {r["slice"]: r["n"] for r in stored.groupBy("slice").agg(F.count("*").alias("n")).collect()}
        parts = [(stored.filter(F.col("slice") == s).drop("slice"), m) for s, m in sorted(sizes.items())]
    out = None
    for at, (rows, m) in enumerate(parts):
        unique, rest = repeated_rows(rows, m, max_bits, f"dedup-{at}")
        rest = cut(rest, f"dedup-rest{at}")
        groups = cut(rest.groupBy("sha").agg(F.max(F.struct("doc_id", "rid")).alias("best"),
                                             F.count("*").alias("group_size")), f"dedup-groups{at}")
        # Both sides are stored tables, so the join's shuffles can be split where one group is large.
        joined = rest.join(groups, "sha").select(
            "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
            (F.col("rid") == F.col("best.rid")).alias("kept"), "sha")
        passed = unique.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                               F.lit(True).alias("kept"), "sha")
        both = passed.unionByName(joined)
        out = both if out is None else out.unionByName(both)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay, with all their columns: whole rows of unique texts never shuffle.

    Same rule as ``dedup_report``; the filter stays within ``max_bits``, and a
    corpus beyond it only has more rows that shuffle.
    """
    columns = docs.columns
    keyed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"),
                        F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("sha"))
    light = cut(keyed.select("doc_id", "sha"), "dedup-light")
    n = light.count()
    bits = int(min(max_bits, max(64, BITS_PER_ROW * n)))
    hit = light.select(F.explode(F.array(*positions(F.col("sha"), bits, HASHES))).alias("bit"))
    twice = bitmap(hit.groupBy("bit").agg(F.count("*").alias("n")).filter("n > 1").select("bit"), bits, "dedup-twice")
    maybe = may_contain(twice, F.col("sha"), bits, HASHES)
    best = cut(light.filter(maybe).groupBy("sha").agg(F.max("doc_id").alias("keep_id")), "dedup-best")
    kept = (keyed.filter(maybe).join(best, "sha").filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("sha").agg(F.any_value("row").alias("row")))
    rows = keyed.filter(~maybe).select("row").unionByName(kept.select("row"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])
