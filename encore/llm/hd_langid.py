"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A
trigram is the product of its letters' vectors, the first rotated by two
places, the second by one (binding with permutation, so that order counts);
a text is the sum of its trigrams' vectors (bundling). A language's prototype
is the sum over its texts, and a text belongs to the language whose prototype
has the largest cosine with it.

Learning is one pass: each task adds up trigram counts by language, multiplies
them out once at its end, and the integer sums of all tasks are added by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import annotate, prepare

DIMENSIONS = 1024
SEED = 20_240
#: Most trigrams whose vectors a task keeps (4 KB each).
CACHED_TRIGRAMS = 24_000
#: Most languages that may be learned; their prototypes are sent to every task (8 KB each).
MAX_LANGUAGES = 2000
UNDETERMINED = "und"


class Letters:
    """Code points of lower-case letters; everything else is one space."""

    def __init__(self):
        self.table = np.zeros(0x110000, np.uint32)
        points = np.arange(0x110000)
        letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        self.table[letters] = points[letters]

    def trigrams(self, text: str | None) -> np.ndarray:
        """The trigrams of a text as numbers; none if it has no letter."""
        if not text:
            return np.zeros(0, np.int64)
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.table[points]
        if not letters.any():
            return np.zeros(0, np.int64)
        letters = np.concatenate([[0], letters, [0]]).astype(np.int64)
        gap = letters == 0
        letters = letters[~(gap & np.concatenate([[False], gap[:-1]]))]  # one space for any number
        if len(letters) < 3:
            return np.zeros(0, np.int64)
        return letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:]


class Profiles:
    """Vectors of trigrams, kept for those seen."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.letter: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.vectors = np.zeros((1024, dimensions), np.float32)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letter:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, point])).integers(0, 2, self.dimensions)
            self.letter[point] = (bits * 2 - 1).astype(np.int8)
        return self.letter[point]

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Rows of ``vectors`` of distinct trigrams."""
        if len(self.row) + len(grams) > CACHED_TRIGRAMS:
            self.row.clear()
        out = np.empty(len(grams), np.int64)
        for i, g in enumerate(grams.tolist()):
            at = self.row.get(g)
            if at is None:
                at = self.row[g] = len(self.row)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                mask = (1 << 21) - 1
                self.vectors[at] = (np.roll(self._letter(g >> 42), 2) * np.roll(self._letter(g >> 21 & mask), 1)
                                    * self._letter(g & mask))
            out[i] = at
        return out

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors, in parts of bounded size."""
        out = np.zeros(self.dimensions, np.float64)
        for i in range(0, len(grams), 8192):
            rows = self.rows(grams[i:i + 8192])
            out += counts[i:i + 8192].astype(np.float32) @ self.vectors[rows]
        return out


def counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64),) * 2


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS,
          seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototypes of all languages that ``docs`` has texts with letters of; null languages and texts teach nothing."""
    prepare(docs.sparkSession)
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches):
        letters, profiles = Letters(), Profiles(dimensions, seed)
        totals: dict[str, dict[int, int]] = {}
        for b in batches:
            by_lang: dict[str, list] = {}
            for name, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                by_lang.setdefault(name, []).append(letters.trigrams(t))
            for name, parts in by_lang.items():
                own = totals.setdefault(name, {})
                for g, n in zip(*(x.tolist() for x in counted(parts))):
                    own[g] = own.get(g, 0) + n
                if len(own) > CACHED_TRIGRAMS:
                    yield _part(name, own, profiles)
                    totals[name] = {}
        for name, own in totals.items():
            if own:
                yield _part(name, own, profiles)

    parts = rows.mapInArrow(run, "lang string, sums array<bigint>")
    sums = (parts.select("lang", F.posexplode("sums").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("x"))
            .select("lang", F.col("x.n").alias("sums")))
    found = sums.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array(r["sums"], np.float64) for r in sorted(found, key=lambda r: r["lang"])}


def _part(name: str, counts: dict[int, int], profiles: Profiles) -> pa.RecordBatch:
    """A task's share of a prototype: exact, as the counts are summed in integers."""
    grams, n = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))
    total = np.zeros(profiles.dimensions, np.int64)
    for i in range(0, len(grams), 4096):
        rows = profiles.rows(grams[i:i + 4096])
        total += n[i:i + 4096] @ profiles.vectors[rows].astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([total.tolist()], pa.list_(pa.int64()))],
                                      names=["lang", "sums"])


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS,
            seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score`` (the cosine, at least 0) beside ``row``.

    A null text or one without a letter is ``und`` with the score 0, and so is
    every text if nothing was learned; of equal cosines the language first by
    name wins. Repeated rows get equal results; an empty table gives none.
    """
    spark = prepare(docs.sparkSession)
    names = sorted(prototypes)
    unit = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names]).reshape(len(names), dimensions)
    sent = spark.sparkContext.broadcast((names, unit))

    def run(batches):
        langs, units = sent.value
        letters, profiles = Letters(), Profiles(dimensions, seed)
        for b in batches:
            pred, score = [], []
            for t in b.column("text").to_pylist():
                grams = letters.trigrams(t)
                best, at = 0.0, -1
                if len(grams) and langs:
                    v = profiles.bundle(*np.unique(grams, return_counts=True))
                    cosines = units @ v / max(np.linalg.norm(v), 1e-300)
                    at = int(np.argmax(cosines))
                    best = float(min(max(cosines[at], 0.0), 1.0))
                pred.append(langs[at] if at >= 0 else UNDETERMINED)
                score.append(best)
            yield pa.RecordBatch.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=["lang_pred", "score"])

    return annotate(docs, text, run, "lang_pred string, score double")
