"""Importance resampling of documents towards a target distribution, by hashed n-grams.

Lower-cased words, their separators collapsed to single spaces, are scanned by
a regular expression with overlapping matches: a match begins and ends at the
boundary of a word and is an n-gram as it stands in the text, a span of bytes.
The CRC-32 of the span gives its bucket. From the counts of all buckets in the
corpus and in the target comes a gain per bucket, and a document's weight is
the mean gain of its n-grams. Weights with Gumbel noise that is fixed by the
document's id rank the documents; the best are drawn without replacement.

Texts are scanned once, each document keeping its counts by bucket. Scores are
whole numbers in a range that the formulas bound, so the cut is found from
their counts; only the rows above it are sorted, over all tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import WORD_BYTES, cut, prepare, texts_of

SHORTEST, LONGEST, BUCKETS = 1, 1, 10_000
MIN_WORDS, PERCENT, SEED = 20, 10, "2024"


def collapsed(text: bytes | None) -> bytes:
    """The lower-cased words of a UTF-8 text, between single spaces."""
    return b" ".join(text.translate(WORD_BYTES).split()) if text else b""


def scanners(shortest: int, longest: int) -> list[regex.Pattern]:
    """One pattern per number of words. The looks around tie a match to whole words, and the steps inside keep what
    they took, so that an overlapping search finds one match at the beginning of each word."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(shortest, longest + 1)]


def spans(text: bytes | None, shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, end) of all n-grams in the collapsed text."""
    line = collapsed(text)
    return [m.span() for p in scanners(shortest, longest) for m in p.finditer(line, overlapped=True)]


def _scan(shortest: int, longest: int, buckets: int):
    def run(batches):
        patterns = scanners(shortest, longest)
        for b in batches:
            if not b.num_rows:
                continue
            n_words, n_features, keys, counts = [], [], [], []
            for text in texts_of(b, "text"):
                line = collapsed(text)
                found: Counter = Counter()
                for p in patterns:
                    found.update([m.group() for m in p.finditer(line, overlapped=True)])
                key, place = np.unique(np.fromiter((zlib.crc32(f) % buckets for f in found), np.int32, len(found)), return_inverse=True)
                keys.append(key)
                counts.append(np.bincount(place, np.fromiter(found.values(), np.int64, len(found)), len(key)).astype(np.int64))
                n_words.append(line.count(b" ") + 1 if line else 0)
                n_features.append(sum(found.values()))
            ends = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts)))],
                names=["row", "n_words", "n_features", "buckets", "counts"])
    return run


def named(column: str, inside: str = "") -> Column:
    """A column, or a field of the struct ``inside``, whatever its name is."""
    return F.col(inside + "`" + column.replace("`", "``") + "`")


def features(docs: DataFrame, keep: list[str], shortest: int = SHORTEST, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``row`` (the columns ``keep``), ``n_words``, ``n_features`` and the document's ``counts`` in its ``buckets``."""
    kept = [named(c) for c in keep] or [F.lit(None).cast("boolean").alias("none")]
    rows = docs.select(F.struct(*kept).alias("row"), "text")
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(
        "n_words bigint, n_features bigint, buckets array<int>, counts array<bigint>").fields])
    return rows.mapInArrow(_scan(shortest, longest, buckets), schema)


def totals(found: DataFrame) -> DataFrame:
    """``bucket, n`` over all documents."""
    each = found.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x")).select("x.buckets", "x.counts")
    return each.groupBy(F.col("buckets").alias("bucket")).agg(F.sum("counts").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A whole number for every bucket: 1000 times the logarithm of how much likelier it is in the target, one being
    added to every count."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(totals(corpus).withColumnRenamed("n", "s"), "bucket", "left").join(
        totals(target).withColumnRenamed("n", "t"), "bucket", "left").fillna(0)
    both = cut(both, "resample-totals")  # as many rows as buckets
    sums = both.agg((F.sum("s") + buckets).cast("double").alias("S"), (F.sum("t") + buckets).cast("double").alias("T"))
    ratio = (F.col("t") + 1).cast("double") * sums.select("S").scalar() / ((F.col("s") + 1).cast("double") * sums.select("T").scalar())
    table = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("bigint").alias("gain")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("gain").to_numpy()
    return out


def _weigh(gain: np.ndarray):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys, n = b.column("buckets"), b.column("n_features").to_numpy(zero_copy_only=False)
            of = gain[keys.flatten().to_numpy()] * b.column("counts").flatten().to_numpy()
            upto = np.concatenate([[0], np.cumsum(of)])
            ends = np.concatenate([[0], np.cumsum(keys.value_lengths().to_numpy(zero_copy_only=False))])
            weight = np.where(n > 0, (upto[ends[1:]] - upto[ends[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n_words"), b.column("n_features"), pa.array(weight)],
                                             names=["row", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """1000 times a Gumbel variable that the document's id fixes, rounded down. A null id counts as the word null."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, keep: list[str] | None = None, shortest: int = SHORTEST,
             longest: int = LONGEST, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: str = SEED) -> DataFrame:
    """Every document with its weight and score, and the rank of those that are drawn.

    Columns: ``row`` (the columns ``keep`` of the document, all by default),
    ``n_words``, ``n_features``, ``weight`` (the floored mean of the gains, 0
    without n-grams), ``score`` and ``rank``. Of the N documents with at least
    ``min_words`` words the ``percent`` N / 100 (rounded down) with the highest
    scores are drawn, ties to the smaller ``doc_id``, a null id last; ``rank``
    counts them from 1 and is null for all others.

    Null and empty texts have no words. Repeated rows are documents of their
    own, with equal scores and different ranks. Either table may be empty: the
    counts that it lacks are 0. Long texts count as a whole.
    """
    spark = prepare(docs.sparkSession)
    keep = list(docs.columns) if keep is None else keep
    with_id = keep if "doc_id" in keep else [*keep, "doc_id"]
    found = cut(features(docs, with_id, shortest, longest, buckets), "resample-features")
    gain = gains(found, features(target, [], shortest, longest, buckets), buckets)
    schema = T.StructType([*found.schema.fields[:3], T.StructField("weight", T.LongType())])
    scored = found.mapInArrow(_weigh(gain), schema).withColumn("score", F.col("weight") + noise(F.col("row.doc_id"), seed))
    scored = cut(scored, "resample-scored")
    return _ranked(scored, min_words, percent).select(
        F.struct(*[named(c, "row.") for c in keep]).alias("row"), "n_words", "n_features", "weight", "score", "rank")


def _ranked(scored: DataFrame, min_words: int, percent: int) -> DataFrame:
    large = F.col("n_words") >= min_words
    # Scores are sums of a mean of logarithms of bounded counts and of noise between -3,200 and 22,900: some ten
    # thousand different ones at any size.
    each = cut(scored.filter(large).groupBy("score").agg(F.count("*").alias("n")), "resample-scores")
    drawn = percent * (each.agg(F.sum("n").alias("n")).first()["n"] or 0) // 100
    none = F.lit(None).cast("bigint")
    if not drawn:
        return scored.withColumn("rank", none)
    upto = each.select("score", F.sum("n").over(Window.orderBy(F.desc("score"))).alias("upto"))
    least = upto.filter(F.col("upto") >= drawn).agg(F.max("score").alias("s")).first()["s"]
    high = large & (F.col("score") >= least)
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("salt")]
    top = scored.filter(high).withColumn("id", F.col("row.doc_id")).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    top = top.repartitionByRange(*order).sortWithinPartitions(*order).drop("id", "salt")
    top = cut(top.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "resample-top")
    parts = top.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per task
    parts = cut(parts.select("part", "first", F.coalesce(before, F.lit(0)).alias("before")), "resample-parts")
    rank = F.col("at") - F.col("first") + F.col("before") + 1
    ranked = top.join(F.broadcast(parts), "part").withColumn("rank", F.when(rank <= drawn, rank))
    return ranked.select(*scored.columns, "rank").unionByName(scored.filter(~high).withColumn("rank", none))
