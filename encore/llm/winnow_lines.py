"""Line dedup by winnowing over line hashes.

A document is the sequence of its non-blank lines, each hashed after trimming.
A passage is a run of ``run`` lines or more, or of fewer with ``words`` words
or more. Of every window of ``run`` consecutive line hashes the minimum is
selected, so any run of that length that two documents share has a selected
fingerprint in common; shorter windows with enough words select theirs among
the windows of their own length. A first pass over the fingerprints finds those
that occur at more than one place; only windows around such a fingerprint go on.
They are the extension of the fingerprint to both sides, by every offset: a
window is known by all its lines, its first place is the smallest by document
and line, and equal windows at later places are repeats. Windows that overlap
chain up to the longest run. No pair of documents is ever made: a group of a
million copies costs a million rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.bitmaps import MAX_BITS, bitmap, keys_bitmap, may_contain, positions
from encore.llm.common import cut, row_key

#: Consecutive lines that make a passage, and words that make one of fewer lines.
RUN, WORDS = 3, 50
BITS_PER_PRINT, HASHES = 16, 2


def windows_of(docs: DataFrame, run: int, words: int) -> DataFrame:
    """Every window of ``run`` non-blank lines, and of fewer with ``words`` words: ``key``, ``at`` (its first line
    among the non-blank ones), ``lines`` (how many), ``fingerprint`` (its minimum, by length), ``selects`` (whether it
    is the first window of its length to select that place; of equal minima the last counts) and its 128-bit identity
    ``w1, w2``. Words are separated by spaces."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    solid = docs.filter("text is not null").select(row_key().alias("key"), lines.alias("lines"))
    hashed = solid.select("key", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"),
                          F.transform("lines", lambda x: F.size(F.split(x, " +"))).alias("n"))
    starts = F.when(F.size("h") > 0, F.sequence(F.lit(0), F.size("h") - 1)).otherwise(F.array().cast("array<int>"))
    opened = hashed.select("key", "h", "n", F.explode(starts).alias("at"))
    part = opened.select("key", "at", *[F.get(c, F.col("at") + i).alias(f"{c}{i + 1}") for c in "hn" for i in range(-1, run)])

    def cells(name, first, count):
        return [F.col(f"{name}{i}") for i in range(first, first + count)]

    def least(hashes):
        return F.least(*hashes) if len(hashes) > 1 else hashes[0]

    def offset(hashes):
        out = F.lit(0)
        for i, c in enumerate(hashes):
            out = F.when(c == least(hashes), F.lit(i)).otherwise(out)
        return out

    def passage(first, count):
        whole = F.col(f"h{first}").isNotNull() & F.col(f"h{first + count - 1}").isNotNull()
        return whole if count == run else whole & (sum(cells("n", first, count), F.lit(0)) >= words)

    def window(count):
        before, own = cells("h", 0, count), cells("h", 1, count)
        print_ = least(own) if count == run else F.xxhash64(F.lit(count), least(own))
        return F.when(passage(1, count), F.struct(
            F.lit(count).alias("lines"), print_.alias("fingerprint"),
            (~passage(0, count) | (offset(before) != offset(own) + 1)).alias("selects"),
            F.xxhash64(F.lit(1), *own).alias("w1"), F.xxhash64(F.lit(2), *own).alias("w2")))

    found = F.filter(F.array(*[window(count) for count in range(1, run + 1)]), lambda w: w.isNotNull())
    return part.select("key", "at", F.inline(found))


def repeated_lines(docs: DataFrame, run: int = RUN, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``key, starts``: for each document with repeats, the first line (among its non-blank ones) and the number of
    ``lines`` of all windows whose lines occur at an earlier place."""
    windows = cut(windows_of(docs.select("doc_id", "text"), run, words), "lines-windows")
    prints = windows.filter("selects")
    bits = int(min(max_bits, max(64, BITS_PER_PRINT * prints.count())))
    hit = prints.select(F.explode(F.array(*positions(F.col("fingerprint"), bits, HASHES))).alias("bit"))
    twice = bitmap(hit.groupBy("bit").agg(F.count("*").alias("n")).filter("n > 1").select("bit"), bits, "lines-twice")
    near = cut(windows.filter(may_contain(twice, F.col("fingerprint"), bits, HASHES)).select("key", "at", "lines", "w1", "w2"),
               "lines-near")
    first = near.groupBy("w1", "w2").agg(F.min(F.struct("key", "at")).alias("first"), F.count("*").alias("n"))
    first = cut(first.filter("n > 1").drop("n"), "lines-first")
    # Two stored tables: a window that a third of all documents have is split over tasks.
    later = cut(near.join(first, ["w1", "w2"]).filter(F.struct("key", "at") != F.col("first")).select("key", "at", "lines"),
                "lines-later")
    return later.groupBy("key").agg(F.collect_set(F.struct("at", "lines")).alias("starts"))


def dedup_lines(docs: DataFrame, run: int = RUN, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the lines of later repeated runs deleted, in a struct column ``deduped`` beside ``row``.

    A line goes if it lies in ``run`` consecutive non-blank lines, or in fewer
    that have ``words`` words or more together, that occur, trimmed, at an
    earlier place too: in a document before it (by ``doc_id``, null last, then
    by text), or further up in the same one. Blank lines stay.
    ``deduped`` has ``n_lines`` (non-blank), ``n_removed`` and ``text``. Rows
    that agree in ``doc_id`` and text are one place and lose the same lines.
    Null text stays null; an empty text or table has nothing to lose. Other
    columns, whatever their names, stay in ``row``.
    """
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("key"), "text")
    repeats = cut(repeated_lines(docs, run, words, max_bits), "lines-repeats")
    bits = int(min(max_bits, max(64, BITS_PER_PRINT * repeats.count())))
    known = keys_bitmap(repeats.select(F.xxhash64("key").alias("h")), "h", bits, HASHES, 0, "lines-known")
    maybe = may_contain(known, F.xxhash64("key"), bits, HASHES)
    # Documents that lose nothing pass straight through; the others meet their lines by one plan at any size.
    untouched = rows.filter(~maybe).withColumn("starts", F.lit(None).cast("array<struct<at:int,lines:int>>"))
    touched = rows.filter(maybe).join(repeats.hint("merge"), "key", "left")
    found = untouched.unionByName(touched).withColumn("lines", F.split("text", "\n"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    solid = F.filter(every, lambda i: F.trim(F.get("lines", i)) != "")
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s["at"], s["at"] + s["lines"] - 1))))
    marked = found.select("row", "text", "lines", solid.alias("solid"), gone.alias("gone"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.transform("gone", lambda g: F.get("solid", g)))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return marked.select("row", F.struct(
        F.coalesce(F.size("solid"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"), text.alias("text")).alias("deduped"))
