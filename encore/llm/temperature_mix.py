"""Mixing sources to target weights by a temperature.

A source with the share ``p`` of all tokens gets a weight in proportion to
``p ** a``: the exponent 1 keeps the natural shares, 0 makes all sources
equal. The largest exponent whose weights reach the target entropy is sought
by repeated section of [0, 1], and raised where a small source would have to
be repeated more often than allowed.

The budget of a source is realised as permutations of its documents. Each pass
over a source orders its documents by a hash, whose first bits are the block
that a document falls in; the last pass ends where the budget is used up. That
place is found by histograms of the hash's digits: 1024 blocks, then 1024
parts of the one block in which the budget ends, and only the few documents of
the last part are sorted. No task holds a source.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import cut, prepare

TARGET_ENTROPY, MAX_REPEATS, SEED = 0.9, 4.0, 11
#: Exponents are multiples of this.
GRID = 1_000_000
SECTION = 32
#: Bits of the permutation key and of each of its digits.
KEY_BITS, DIGIT = 40, 10
#: Most sources whose plan (about 100 bytes each) is sent to every task; beyond it the plan is joined by a shuffle.
BROADCAST_SOURCES = 50_000
#: Blocks of the whole mixture.
BLOCKS = 1024


def tokens(text: str = "text") -> Column:
    """Tokens of a text: its words between white space; none for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("bigint")


def permutation_key(row: Column, epoch: Column, seed: int) -> Column:
    """Place of a document in a pass over its source, a number of 40 bits."""
    return F.pmod(F.xxhash64(F.lit(seed), epoch.cast("bigint"), row), F.lit(1 << KEY_BITS).cast("bigint"))


def _grid_largest(test: Callable[[list[int]], dict[int, bool]]) -> int:
    """The largest k in [0, GRID] that passes, where all k up to some number pass; 0 if none does."""
    lo, hi = 0, GRID + 1  # lo passes, hi does not
    while hi - lo > 1:
        step = max(1, (hi - lo) // SECTION)
        ks = sorted({k for k in range(lo + step, hi, step)})
        passed = test(ks)
        good = [k for k in ks if passed[k]]
        lo, hi = (max(good) if good else lo), min([k for k in ks if not passed[k]], default=hi)
    return lo


def temperature(totals: DataFrame, budget: int, target_entropy: float = TARGET_ENTROPY,
                max_repeats: float = MAX_REPEATS) -> int:
    """The exponent, in millionths, for ``totals`` (``source``, ``n``; one row per source, n > 0).

    ``target_entropy`` is a share of the largest possible entropy, the
    logarithm of the number of sources.
    """
    stats = totals.agg(F.sum("n").alias("n"), F.count("*").alias("sources")).first()
    whole, sources = stats["n"], stats["sources"]
    if not whole:
        return GRID
    if budget > max_repeats * whole * (1 + 1e-12):
        raise ValueError(f"a budget of {budget} tokens repeats {whole} tokens more than {max_repeats} times")
    log_p = F.log(F.col("n") / whole)

    def measured(ks: list[int]) -> dict[int, tuple[float, float]]:
        """Entropy, and the most repeats of a source, by exponent."""
        a = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
        rows = totals.select(log_p.alias("lp"), a).withColumn("a", F.col("k") / GRID)
        rows = rows.withColumn("e", F.exp(F.col("a") * F.col("lp")))
        sums = rows.groupBy("k").agg(F.sum("e").alias("z"), F.sum(F.col("e") * F.col("a") * F.col("lp")).alias("s"),
                                     F.max(F.exp((F.col("a") - 1) * F.col("lp"))).alias("r"))
        sums = sums.select("k", (F.log("z") - F.col("s") / F.col("z")).alias("entropy"),
                           (F.col("r") / F.col("z") * (budget / whole)).alias("repeats"))
        return {r["k"]: (r["entropy"], r["repeats"]) for r in sums.collect()}

    target = target_entropy * math.log(sources) - 1e-9

    def even_enough(ks):
        return {k: e >= target for k, (e, _) in measured(ks).items()}

    def too_often(ks):
        return {k: r > max_repeats * (1 + 1e-9) for k, (_, r) in measured(ks).items()}

    entropic = GRID if even_enough([GRID])[GRID] else _grid_largest(even_enough)
    if too_often([entropic])[entropic]:
        return min(GRID, _grid_largest(too_often) + 1)
    return entropic


def plan(light: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY,
         max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per source: ``source, n, weight, tokens`` (its budget), ``full`` (whole passes) and ``last`` (the key of
    the last document of the partial pass; -1 if there is none).

    ``light``: ``source``, ``row`` (identity of a document), ``n`` (tokens), stored.
    """
    totals = cut(light.groupBy("source").agg(F.sum("n").alias("n")).filter("n > 0"), "mix-totals")
    whole = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    budget = whole if budget is None else budget
    exponent = temperature(totals, budget, target_entropy, max_repeats) / GRID
    power = totals.select("source", "n", F.pow(F.col("n") / max(whole, 1), F.lit(exponent)).alias("e"))
    z = power.agg(F.sum("e").alias("z")).first()["z"] or 1.0
    sources = power.select("source", "n", (F.col("e") / z).alias("weight"))
    sources = sources.withColumn("tokens", F.round(F.col("weight") * budget).cast("bigint"))
    sources = sources.withColumn("full", F.expr("tokens div n")).withColumn("rest", F.expr("tokens - full * n"))
    sources = cut(sources, "mix-sources")
    # Where the partial pass of each source ends: block, part of the block, document.
    keyed = _beside(light, sources.filter("rest > 0").select("source", "full", "rest")).select(
        "source", "rest", "n", permutation_key(F.col("row"), F.col("full"), seed).alias("u"))
    before = F.lit(0).cast("bigint")
    for level in (1, 2):
        digit = F.shiftright("u", KEY_BITS - level * DIGIT)
        if level == 2:
            keyed = _beside(keyed.drop("before"), at, ("source",)).filter(
                F.shiftright("u", KEY_BITS - DIGIT) == F.col("cell")).drop("cell")
        sums = keyed.groupBy("source", digit.alias("cell")).agg(
            F.sum("n").alias("n"), F.first("rest").alias("rest"), F.first(before).alias("base"))
        running = F.sum("n").over(Window.partitionBy("source").orderBy("cell")) + F.col("base")
        at = cut(sums.withColumn("cum", running).filter("cum >= rest").groupBy("source").agg(
            F.min_by(F.struct("cell", (F.col("cum") - F.col("n")).alias("before")), "cell").alias("x"))
            .select("source", "x.cell", "x.before"), f"mix-cell{level}")
        before = F.col("before")
    few = _beside(keyed.drop("before"), at, ("source",)).filter(F.shiftright("u", KEY_BITS - 2 * DIGIT) == F.col("cell"))
    few = few.groupBy("source", "u").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    running = F.sum("n").over(Window.partitionBy("source").orderBy("u")) + F.col("before") - F.col("n")
    last = few.withColumn("cum", running).filter("cum < rest").groupBy("source").agg(F.max("u").alias("last"))
    found = cut(last, "mix-last")
    out = sources.join(found, sources["source"].eqNullSafe(found["source"]), "left").select(
        sources["source"], "n", "weight", "tokens", "full", F.coalesce("last", F.lit(-1)).cast("bigint").alias("last"))
    return cut(out, "mix-plan")


def _beside(rows: DataFrame, small: DataFrame, on: tuple[str, ...] = ("source",)) -> DataFrame:
    """Join a table with one row per source, sent to all tasks where it is small."""
    if small.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        small = F.broadcast(small)
    small = small.withColumnRenamed("source", "source_")
    return rows.join(small, rows["source"].eqNullSafe(small["source_"])).drop("source_")


def mix(docs: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY,
        max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixture: one row per use of a document, ``row`` with ``n_tokens``, ``epoch``, ``place`` and ``block``.

    ``docs`` has ``doc_id``, ``text`` and ``source``; a null source is one of
    its own. ``budget`` is in tokens, by default as many as there are. Every
    source is used in whole passes and a partial one, which ends with the
    document that reaches the budget, so it goes over by less than a document
    (rows that agree in id and text are used together). ``place`` in [0, 1)
    orders the mixture so that every stretch has about the target weights, and
    ``block`` is its 1024th. Null and empty texts have no tokens and come with
    the passes; sources without any token, and empty tables, give nothing.
    """
    prepare(docs.sparkSession)
    row = F.xxhash64("doc_id", "text")
    light = cut(docs.select("source", row.alias("row"), tokens().alias("n")), "mix-light")
    sources = plan(light, budget, target_entropy, max_repeats, seed)
    rows = docs.select(F.struct("*").alias("row"), "source", row.alias("r"), tokens().alias("n_tokens"))
    used = _beside(rows, sources.select("source", "full", "last", (F.col("tokens") / F.col("n")).alias("passes")))
    partial = permutation_key(F.col("r"), F.col("full"), seed) <= F.col("last")
    copies = F.col("full") + partial.cast("bigint")
    each = used.withColumn("epoch", F.explode(F.when(
        copies > 0, F.sequence(F.lit(0).cast("bigint"), copies - 1)).otherwise(F.array().cast("array<bigint>"))))
    within = permutation_key(F.col("r"), F.col("epoch"), seed) / float(1 << KEY_BITS)
    place = F.least((F.col("epoch") + within) / F.col("passes"), F.lit(1 - 1e-12))
    return each.select("row", "n_tokens", "epoch", place.alias("place"), F.floor(place * BLOCKS).cast("int").alias("block"))
