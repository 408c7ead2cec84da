"""URL filters by a Bloom filter cascade.

A list of rules ``host/path`` is tested for every url without a join. A rule
fits its host and all subdomains when the url's path starts with the rule's
path; the keys a url can match are therefore a few suffixes of its host, each
with a few prefixes of its path (only the shapes that the list has).

Level 1 of the cascade encodes the listed keys. Level 2 encodes the unlisted
keys *of the corpus* that level 1 takes for listed, level 3 the listed keys
that level 2 takes for one of those, and so on until a level has no false
positive. As every key that can be asked for is in the universe that the
levels were built over, the answer is exact. The first level has the false
positive rate ``r / (sqrt(2) * s)`` for ``r`` listed and ``s`` unlisted keys
and the others 1/2, which makes the whole about ``1.44 r log2(s / r)`` bits.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.bitmaps import MAX_BITS, keys_bitmap, may_contain
from encore.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or a url without ``://``."""
    rest = F.get(F.split(url, "://", 2), 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def shape(rule: str) -> tuple[int, int]:
    """(labels of the host, characters of the path) of a rule."""
    host, slash, path = rule.partition("/")
    if not host:
        raise ValueError(f"a rule needs a host: {rule!r}")
    return host.count(".") + 1, len(slash + path)


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> list[Column]:
    """The key a url has for each shape, longest first; null where it has none."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    out = []
    for n, m in sorted(shapes, reverse=True):
        key = F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m) if m else F.lit(""))
        out.append(F.when((host != "") & (labels >= n) & (F.length(path) >= m), key))
    return out


def bits_for(n: int, rate: float) -> int:
    """Bits of a filter of ``n`` keys with a false positive rate."""
    return max(64, math.ceil(1.45 * n * -math.log2(rate)))


def first_rate(n_in: int, n_out: int) -> float:
    """False positive rate of level 1."""
    return min(0.5, n_in / (math.sqrt(2) * n_out)) if n_out else 0.5


class Cascade:
    """Exact membership in a list for every key of a universe, as a column expression.

    A list whose first level would need more than ``max_bits`` is split into
    ``parts`` by a hash of the key, each with a cascade of its own. ``contains``
    takes one part, so that its filters alone are sent with the rows.
    """

    def __init__(self, universe: DataFrame, listed: list[str], name: str, max_bits: int = MAX_BITS):
        """``universe``: distinct values in a column ``key``. ``listed``: the list, which may have keys beyond it."""
        spark = universe.sparkSession
        given = spark.createDataFrame([(k,) for k in listed], "key string")
        # One grouping marks the listed keys of the universe.
        marked = (universe.select("key", F.lit(False).alias("listed"), F.lit(True).alias("asked"))
                  .unionByName(given.select("key", F.lit(True).alias("listed"), F.lit(False).alias("asked")))
                  .groupBy("key").agg(F.max("listed").alias("listed"), F.max("asked").alias("asked"))
                  .filter("asked").select("key", "listed"))
        marked = cut(marked, f"{name}-universe")
        counts = {r["listed"]: r["n"] for r in marked.groupBy("listed").agg(F.count("*").alias("n")).collect()}
        n_in, n_out = counts.get(True, 0), counts.get(False, 0)
        whole = bits_for(n_in, first_rate(n_in, n_out)) if n_in else 0
        # A fifth is left free, as a hash does not split evenly.
        self.parts = 1 if whole <= max_bits else math.ceil(1.25 * whole / max_bits)
        self.levels: list[list[tuple[DataFrame, int, int, int]]] = []
        for part in range(self.parts):
            own = marked if self.parts == 1 else marked.filter(self.part_of(F.col("key")) == part)
            if self.parts > 1:
                counts = {r["listed"]: r["n"] for r in own.groupBy("listed").agg(F.count("*").alias("n")).collect()}
            self.levels.append(self._levels(own, counts.get(True, 0), counts.get(False, 0), f"{name}-{part}"))

    def part_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(self.parts))

    def _levels(self, marked: DataFrame, n_in: int, n_out: int, name: str) -> list[tuple[DataFrame, int, int, int]]:
        inside, outside = marked.filter("listed").select("key"), marked.filter("not listed").select("key")
        levels: list[tuple[DataFrame, int, int, int]] = []
        while n_in:
            level = len(levels) + 1
            rate = first_rate(n_in, n_out) if level == 1 else 0.5
            hashes, bits = max(1, round(-math.log2(rate))), bits_for(n_in, rate)
            filter_ = keys_bitmap(inside, "key", bits, hashes, level, f"{name}-{level}")
            levels.append((filter_, bits, hashes, level))
            # What the level wrongly takes for one of its own is the next level's set.
            wrong = cut(outside.filter(may_contain(filter_, F.col("key"), bits, hashes, level)), f"{name}-wrong{level}")
            inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in
        return levels

    def contains(self, key: Column, part: int = 0) -> Column:
        """Whether a key of the universe is listed, in a part of the list; false for null."""
        if part >= self.parts:
            return F.lit(False)
        levels = self.levels[part]
        found = F.lit(len(levels) % 2 == 1)
        for at in range(len(levels) - 1, -1, -1):
            filter_, bits, hashes, seed = levels[at]
            found = F.when(may_contain(filter_, key, bits, hashes, seed), found).otherwise(F.lit(at % 2 == 1))
        return key.isNotNull() & found if self.parts == 1 else key.isNotNull() & (self.part_of(key) == part) & found


def judge_urls(pages: DataFrame, rules: Mapping[str, str], blocked: list[str], url: str = "url",
               max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` in a struct ``judged``.

    ``rules`` maps a rule to ``allow`` or ``block``; of those that fit, the
    longest wins: most host labels, then the longest path. Where none fits, a
    url is blocked if an entry of ``blocked`` (same syntax) fits, else allowed.
    A null url, one without ``://`` and one without a host fit nothing and are
    allowed. Repeated rows and ties are judged alike; an empty table gives an
    empty result; other columns, whatever their names, stay in ``row``. A list
    whose filter would need more than ``max_bits`` takes one pass for each of
    its parts, so that no more is ever sent to an executor at once.
    """
    for rule, verdict in rules.items():
        if verdict not in ("allow", "block"):
            raise ValueError(f"{rule!r}: {verdict!r}")
    host, path = host_and_path(F.col(url))
    split = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    shapes = sorted({shape(r) for r in [*rules, *blocked]})
    keys = candidates(F.col("host"), F.col("path"), shapes)
    if not keys:
        return split.select("row", F.struct("host", "path", F.lit(None).cast("string").alias("rule"),
                                            F.lit("allow").alias("verdict")).alias("judged"))
    universe = cut(split.select(F.explode(F.array(*keys)).alias("key")).filter("key is not null").distinct(), "url-keys")
    lists = {"allow": [r for r, v in rules.items() if v == "allow"],
             "block": [r for r, v in rules.items() if v == "block"], "default": list(blocked)}
    cascades = {k: Cascade(universe, v, f"urls-{k}", max_bits) for k, v in lists.items()}
    names = [F.col(f"k{i}") for i in range(len(keys))]
    found = split.select("*", *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    passes = max(c.parts for c in cascades.values())
    for part in range(passes):
        fits = {v: F.coalesce(*[F.when(cascades[v].contains(k, part), F.struct(F.lit(-i).alias("at"), k.alias("rule")))
                                for i, k in enumerate(names)]) for v in lists}
        if part:  # the longest of all parts
            fits = {v: F.greatest(F.col(v), best) for v, best in fits.items()}
        last = part == passes - 1
        found = found.select("row", "host", "path", *([] if last else names), *[best.alias(v) for v, best in fits.items()])
        if not last:
            found = cut(found, f"urls-part{part}")
    by_default = F.when(F.col("default").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    allowed = F.col("block.at").isNull() | (F.col("allow.at") > F.col("block.at"))
    verdict = (F.when(F.col("allow.at").isNotNull() & allowed, F.lit("allow"))
               .when(F.col("block.at").isNotNull(), F.lit("block")).otherwise(by_default))
    rule = F.when(F.col("allow.at").isNotNull() & allowed, F.col("allow.rule")).otherwise(F.col("block.rule"))
    return found.select("row", F.struct("host", "path", rule.alias("rule"), verdict.alias("verdict")).alias("judged"))
