"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over which words and beginnings of words a text has (not
how often, so that a long text is not clean for being long). In every labelled
text that mentions a group of people, the mention is swapped for another group
of its kind; the training loss adds the squared difference of the two scores'
logits, so that naming a group carries no weight of its own.

The model is fitted on at most ``max_labelled`` labelled rows, drawn by a hash
of their id; feature counts are made by Spark, and the features that are
clearly tied to a class, at most ``max_features``, go to the fit.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import annotate, cut, give_back, prepare, texts_of, words_of

MAX_LABELLED, MAX_FEATURES = 20_000, 20_000
#: Lengths, in characters, of the beginnings of words that are features.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: A feature counts if it is in so many toxic texts, and its rates in the two classes lie so many standard errors apart.
LEAST_TOXIC, LEAST_Z = 5, 4.0
#: Words whose features a task keeps, and features of texts in one batch that it hands on (of the last text more).
CACHED_FEATURES, BATCH_FEATURES = 50_000, 250_000
L2, COUNTERFACTUAL = 0.02, 20.0
THRESHOLD = 0.7

#: Groups of interchangeable mentions, lower case.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"), ("mothers", "fathers"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual"), ("transgender", "cisgender"),
    ("immigrants", "natives", "refugees", "foreigners"), ("immigrant", "native", "refugee", "foreigner"),
    ("old", "young"), ("disabled", "deaf", "blind"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "españoles"),
)


def features_of_word(word: bytes) -> list[int]:
    """Numbers of the features that a word gives: itself, and its beginnings."""
    out = [zlib.crc32(b"w" + word)]
    if len(word) >= PREFIXES[0]:
        letters = word.decode("utf-8", "replace")
        out += [zlib.crc32(b"p" + letters[:n].encode()) for n in PREFIXES if len(letters) >= n]
    return out


class Features(dict):
    """Features of words, kept for the frequent ones; emptied when large. ``only``: the features that count."""

    def __init__(self, only: frozenset | None = None):
        super().__init__()
        self.only = only

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHED_FEATURES:
            self.clear()
        found = features_of_word(word)
        out = self[word] = tuple(f for f in found if self.only is None or f in self.only)
        return out

    def of(self, words) -> set[int]:
        return set().union(*map(self.__getitem__, set(words)))


def swapped(words: list[bytes], terms: tuple[tuple[str, ...], ...]) -> list[list[bytes]]:
    """The text with its mentions swapped: once for each other member of the largest group it mentions."""
    groups = {t.encode(): g for g in terms for t in g}
    used = {g for w in set(words) if (g := groups.get(w))}
    out = []
    for shift in range(1, max(map(len, used), default=1)):
        to = {t.encode(): g[(i + shift) % len(g)].encode() for g in used for i, t in enumerate(g)}
        out.append([to.get(w, w) for w in words])
    return out


@dataclass
class Model:
    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED,
        max_features: int = MAX_FEATURES, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """A model of the labelled rows of ``docs`` (``doc_id``, ``text``) with ``labels`` (``doc_id``, ``label``).

    Null ids and labels teach nothing; of several labels of an id the largest
    counts, and of several texts the smallest, so that an id is one row
    however often it is repeated; null text counts as empty. Without a row of both classes the model
    gives every text the rate of the class it saw, 0 without any.
    """
    spark = prepare(docs.sparkSession)
    known = labels.filter(f"doc_id is not null and {label} is not null").groupBy("doc_id").agg(F.max(label).alias("y"))
    drawn = known.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(max_labelled)
    # At most max_labelled rows of two numbers: their texts are picked without a shuffle of the others.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.first("y").alias("y"), F.min("text").alias("text")).select("doc_id", "y", "text")

    seen = cut(rows.mapInArrow(_extract(terms), "doc_id bigint, y int, own array<bigint>, other array<array<bigint>>"), "toxic-rows")
    n = {r["y"]: r["n"] for r in seen.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return Model(bias=math.log((n1 + 1e-3) / (n0 + 1e-3)) if n1 + n0 else -20.0)
    counts = seen.select("y", F.explode("own").alias("f")).groupBy("f").agg(
        F.sum("y").alias("k1"), F.sum(1 - F.col("y")).alias("k0")).filter(F.col("k1") >= LEAST_TOXIC)
    p, q, r = F.col("k1") / n1, F.col("k0") / n0, (F.col("k1") + F.col("k0")) / (n1 + n0)
    z = (p - q) / F.sqrt(r * (1 - r) * (1 / n1 + 1 / n0) + 1e-12)
    mentions = frozenset(f for g in terms for t in g for f in features_of_word(t.encode()))
    chosen = counts.withColumn("z", z).filter(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "f").limit(max_features)
    index = sorted({r["f"] for r in chosen.select("f").collect()} | mentions)
    of = {f: i for i, f in enumerate(index)}
    sent = spark.sparkContext.broadcast(frozenset(index))

    def restrict(batches):
        wanted = sent.value
        for b in batches:
            own = [sorted(wanted.intersection(o)) for o in b.column("own").to_pylist()]
            other = [[sorted(wanted.intersection(x)) for x in o] for o in b.column("other").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array(own, pa.list_(pa.int64())),
                 pa.array(other, pa.list_(pa.list_(pa.int64())))], names=["doc_id", "y", "own", "other"])

    small = seen.mapInArrow(restrict, seen.schema)
    kept = sorted((r["doc_id"], r["y"], r["own"], r["other"]) for r in small.collect())
    x = _sparse([[of[f] for f in own] for _, _, own, _ in kept])
    y = np.array([r[1] for r in kept], np.float64)
    pairs = [(i, [of[f] for f in o]) for i, (_, _, _, others) in enumerate(kept) for o in others]
    swaps = _sparse([o for _, o in pairs])
    weights, bias = _descend(x, y, np.array([i for i, _ in pairs], np.int64), swaps, len(index))
    return Model({f: float(w) for f, w in zip(index, weights) if abs(w) > 1e-6}, float(bias))


def _extract(terms: tuple[tuple[str, ...], ...]):
    """The features of every text, and those of its swapped forms, in batches of about ``BATCH_FEATURES``."""
    def run(batches):
        all_of = Features()
        for b in batches:
            ids, ys, at = b.column("doc_id"), b.column("y").cast(pa.int32()), 0
            own, other, held = [], [], 0

            def batch():
                arrays = [ids.slice(at, len(own)), ys.slice(at, len(own)), pa.array(own, pa.list_(pa.int64())),
                          pa.array(other, pa.list_(pa.list_(pa.int64())))]
                return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "y", "own", "other"])

            for t in texts_of(b, "text"):
                words = words_of(t)
                own.append(sorted(all_of.of(words)))
                other.append([sorted(all_of.of(x)) for x in swapped(words, terms)])
                held += len(own[-1]) + sum(map(len, other[-1]))
                if held >= BATCH_FEATURES:
                    yield batch()
                    at, own, other, held = at + len(own), [], [], 0
            if own:
                yield batch()
        give_back()
    return run


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row numbers, columns, rows) of a 0/1 matrix."""
    sizes = [len(r) for r in rows]
    return (np.repeat(np.arange(len(rows)), sizes), np.array([c for r in rows for c in r], np.int64), len(rows))


def _times(m, w: np.ndarray) -> np.ndarray:
    return np.bincount(m[0], w[m[1]], m[2])


def _back(m, v: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(m[1], v[m[0]], n)


def _descend(x, y, owner, swaps, n: int, steps: int = 3000) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on mean log loss + l2 + the counterfactual penalty."""
    w, b = np.zeros(n), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    rows, pairs = len(y), max(1, len(owner))
    # Each feature has a step of its own, from a bound of the loss's curvature there.
    width = np.bincount(x[0], minlength=rows).max(initial=1) + 1
    curve = 0.25 * width * _back(x, np.ones(rows), n) / rows + L2 / rows * 2
    if len(owner):
        swap_width = np.bincount(swaps[0], minlength=len(owner)).max(initial=1) + width
        touched = _back(swaps, np.ones(len(owner)), n) + _back(x, np.bincount(owner, minlength=rows).astype(float), n)
        curve += 2 * COUNTERFACTUAL * swap_width * touched / pairs
    curve_b = 0.25 * width
    v, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        z = _times(x, v) + vb
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / rows
        grad = _back(x, g, n) + 2 * L2 / rows * v
        if len(owner):
            apart = (_times(x, v)[owner] - _times(swaps, v)) * 2 * COUNTERFACTUAL / pairs
            grad += _back(x, np.bincount(owner, apart, rows), n) - _back(swaps, apart, n)
        nw, nb = v - grad / curve, vb - g.sum() / curve_b
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``) beside ``row``.

    Null and empty texts have no features and get the score of the bias;
    repeated rows get equal scores; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = sent.value.weights, sent.value.bias
        features = Features(frozenset(weights))
        for b in batches:
            out = []
            for t in texts_of(b, "text"):
                found = features.of(words_of(t))
                z = bias + math.fsum(map(weights.__getitem__, found))
                out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()),
                                              pa.array([int(s >= threshold) for s in out], pa.int32())],
                                             names=["score", "predicted"])

    return annotate(docs, text, run, "score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, whole and with their own columns."""
    return score(docs, model, threshold=threshold).filter("predicted = 0").select("row.*")
