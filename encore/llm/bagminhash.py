"""Near-duplicate documents by BagMinHash signatures.

A document is the multiset of its shingles of five words. Think of every
shingle as a strip of the plane, weight upwards and time to the right, with a
Poisson process of points that depends on the shingle alone; a document sees
the points below its weight of the shingle. Every point has one of ``m``
components, and component ``i`` of the signature is the first point in time
that the document sees with that component. Two documents agree in a component
with a probability of exactly their weighted Jaccard similarity, the sum of
minimum weights over the sum of maximum weights.

The strip is divided hierarchically, into the weights (0, 1], (1, 2], (2, 4],
(4, 8], ..., each a process with a seed and a rate of its own, and inside a
part points have discrete levels; a document with the weight 5 generates the
first three parts and of the fourth keeps the points up to level 5. Only
points up to a time by which all components are very likely taken are made; a
document for which that was too early is done again with twice the time.

Signatures are banded. Copies with equal words are one node, represented by
one document. In a bucket every member is compared with the smallest member.
Of the members that this leaves in different classes, all pairs that can be
similar are compared, found by their rarest shingles: where very many texts
meet at a shingle, first all with the one that has least besides, and what is
then still apart by sizes and places that can reach the similarity. Candidate
pairs are checked exactly, and classes are the connected components of the
links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.bitmaps import MAX_BITS, keys_bitmap, may_contain
from encore.llm.common import annotate, collected, cut, give_back, mix64, prepare, remove, row_key, stored, texts_of, words_of
from encore.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Texts that a shingle is in to count as frequent among those that are left, and the most such shingles whose counts
#: are sent to all tasks (16 MB). Both only decide the order of shingles, not what is found.
FREQUENT, MAX_FREQUENT = 8, 1_000_000
#: Texts from which on those that meet at a shingle are joined by steps of their number of shingles, and the step's ratio.
MANY, SIZE_STEP = 8, 1.02
#: Words whose hashes a task keeps.
CACHED_HASHES = 200_000


class WordHashes(dict):
    """64-bit hashes of words, kept for the frequent ones; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_HASHES:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """64-bit hashes of all runs of five words, in order; of the whole text if it has fewer words, but not none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        out = mix64(out * GOLDEN + h[i:i + len(out)])
    return out


def weighted(per_doc: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, shingle, weight) of the multisets of several documents."""
    doc, key, weight = [], [], []
    for d, s in enumerate(per_doc):
        if len(s):
            k, w = np.unique(s, return_counts=True)
            doc.append(np.full(len(k), d, np.int64))
            key.append(k)
            weight.append(w)
    if not doc:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(doc), np.concatenate(key), np.concatenate(weight)


def signatures(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """``n_docs`` x ``m`` identities of the first points; all 0 for a document without shingles."""
    out = np.zeros((n_docs, m), np.uint64)
    total = np.bincount(doc, weight, n_docs)
    todo, spread = np.flatnonzero(total), 1.0
    while todo.size:
        number = np.full(n_docs, -1, np.int64)
        number[todo] = np.arange(todo.size)
        mine = number[doc] >= 0
        until = spread * m * (math.log(m) + 6) / np.maximum(total, 1)
        first, point = _points(number[doc[mine]], key[mine], weight[mine], until[doc[mine]], todo.size, m)
        done = np.isfinite(first).all(axis=1)
        out[todo[done]] = point[done]
        todo, spread = todo[~done], spread * 2
    return out


def _points(doc, key, weight, until, n_docs: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Time and identity of the first point of each component up to the time ``until`` of each shingle's document."""
    # The parts of each shingle's strip: 0 for (0, 1], c for (2^(c-1), 2^c].
    parts = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    row = np.repeat(np.arange(len(key)), parts)
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    low = np.where(part > 0, 2.0 ** (part - 1), 0.0)
    width = np.where(part > 0, low, 1.0)
    state = mix64(key[row] ^ mix64(part.astype(np.uint64) * GOLDEN + np.uint64(1)))
    flat, limit, top = doc[row] * m, until[row], weight[row]
    time = np.zeros(len(row))
    j = 0
    first, seen = np.full(n_docs * m, np.inf), []
    while len(row):
        # Few open strips: several points of each at once.
        k = int(np.clip(100_000 // len(row), 1, 64))
        steps = np.arange(j, j + k, dtype=np.uint64)
        a = mix64(state[:, None] + (steps * np.uint64(2) + np.uint64(1)) * GOLDEN)
        gaps = -np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        gaps /= width[:, None]
        gaps[:, 0] += time
        at = np.cumsum(gaps, axis=1)
        time = np.ascontiguousarray(at[:, -1])
        b = mix64(a ^ np.uint64(0x5851F42D4C957F2D))
        level = low[:, None] + 1 + np.floor((b >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 * width[:, None])
        keep = (at <= limit[:, None]) & (level <= top[:, None])
        slot = (flat[:, None] + ((b & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64))[keep]
        seen.append((slot, at[keep], a[keep]))
        np.minimum.at(first, slot, at[keep])
        open_ = time <= limit
        state, flat, limit, top = state[open_], flat[open_], limit[open_], top[open_]
        low, width, time, row = low[open_], width[open_], time[open_], row[open_]
        j += k
    point = np.zeros(n_docs * m, np.uint64)
    for slot, at, a in seen:
        best = at == first[slot]
        point[slot[best]] = a[best]
    return first.reshape(n_docs, m), point.reshape(n_docs, m)


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket keys of every document, one per band."""
    part = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), part.shape[:2]).copy()
    for i in range(rows):
        out = mix64(out * GOLDEN + part[:, :, i])
    return out.view(np.int64)


def _sign(bands: int, rows: int):
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            texts, keys, raw = texts_of(b, "text"), [], []
            sigs, sizes = [], []
            for at in range(0, len(texts), 256):
                per_doc = []
                for t in texts[at:at + 256]:
                    words = words_of(t)
                    per_doc.append(shingles(words, hashes))
                    keys.append(hashlib.blake2b(b" ".join(words) if words else b"\0" + (t or b""), digest_size=16).digest())
                doc, key, weight = weighted(per_doc)
                sizes += [len(s) for s in per_doc]
                sigs.append(bands_of(signatures(doc, key, weight, len(per_doc), bands * rows), bands, rows))
            found = np.concatenate(sigs)
            none = np.array(sizes) == 0
            lengths = np.where(none, 0, bands)
            flat = pa.array(found[~none].reshape(-1), pa.int64())
            buckets = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), buckets],
                                             names=["words", "n", "bands"])
    return run


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    (ka, wa), (kb, wb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    least = np.minimum(wa[ia], wb[ib]).sum()
    return float(least / (len(a) + len(b) - least)) if len(a) + len(b) else 0.0


def _among(keys: DataFrame, count: int, column: str = "key") -> Column:
    """Whether ``column`` is among the ``count`` ones of ``keys`` (true for a few more), for a filter on a scan."""
    hashed = F.xxhash64(column)
    bits = int(min(MAX_BITS, max(64, 16 * count)))
    known = keys_bitmap(keys.select(hashed.alias("h")), "h", bits, 3, 0, "near-known")
    return may_contain(known, hashed, bits, 3)


def _holding(texts: DataFrame, keys: DataFrame, count: int) -> DataFrame:
    """The texts whose ``key`` is among ``keys`` (and a few more): only those shuffle."""
    return texts.filter(_among(keys, count))


def _verify(pairs: DataFrame, count: int, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the ``count`` pairs ``a, b`` whose texts are similar. ``texts``: ``key, text``, stored, one row per key."""
    left = _holding(texts, pairs.select(F.col("a").alias("key")), count).select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = _holding(texts, pairs.select(F.col("b").alias("key")).distinct(), count).select(
        F.col("key").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            good, known = [], {}

            def of(t):
                if t not in known:
                    if len(known) > 64:
                        known.clear()
                    known[t] = shingles(words_of(t), hashes)
                return known[t]

            for x, y in zip(texts_of(batch, "text_a"), texts_of(batch, "text_b")):
                good.append(similarity(of(x), of(y)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return full.mapInArrow(run, pairs.select("a", "b").schema)


def near_classes(docs: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, class_key, words`` for every row of ``docs`` (``doc_id``, ``text``): its identity, that of its class.

    Texts with equal words are one class, and so are texts whose multisets of
    five-word shingles have a weighted Jaccard similarity of ``threshold`` or
    more, directly or over others. A text of one to four words is one shingle.
    Texts without words, null counting as empty, are in a class only with equal
    texts. The class is named by its smallest row, by ``doc_id`` (null last),
    then by text; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    with collected() as folders:
        light = annotate(docs.select(row_key().alias("key"), "text"), "text", _sign(bands, rows),
                         "words binary, n bigint, bands array<bigint>").select("row.key", "words", "n", "bands")
        light, light_at = stored(light, "near-light")
        # One node per text with its own words.
        nodes = light.groupBy("words").agg(F.min(F.struct("key", "n", "bands")).alias("m"))
        nodes = cut(nodes.select("words", "m.key", "m.n", "m.bands"), "near-nodes")
        labels = _labels(docs, nodes, threshold)
        of_node = nodes.select("words", F.col("key").alias("node"))
        if labels is None:  # no links between different texts: a class is a node
            of_node = of_node.withColumn("label", F.col("node"))
        else:
            of_node = of_node.join(labels, "node", "left")
        of_node, node_at = stored(of_node.select("words", F.coalesce("label", "node").alias("class_key")), "near-of-node")
        classes = light.join(of_node, "words").select("key", "class_key", "words")
    remove(spark, folders, [light_at, node_at])
    return classes


def _labels(docs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame | None:
    """``node, label`` of the nodes that are linked with others; None if there are none."""
    member = _members(nodes)
    texts = _texts(docs, cut(member.select("key").distinct(), "near-wanted"))
    links = tested = labels = None

    def settle(pairs: DataFrame, texts: DataFrame, name: str) -> None:
        """Check the pairs that are new and join the classes of those that are similar."""
        nonlocal links, tested, labels
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), f"near-pairs-{name}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        count = pairs.count()
        if not count:
            return
        good = cut(_verify(pairs, count, texts, threshold), f"near-links-{name}")
        if not good.isEmpty():
            links = good if links is None else links.unionByName(good)
            labels = components(links, f"near-classes-{name}")

    settle(_first_pairs(member, threshold), texts, "hubs")
    apart = _apart(member, labels, "near-apart").select("key", "n", "label").distinct()
    apart = cut(apart, "near-open")
    texts = cut(_holding(texts, apart.select("key"), apart.count()).join(apart.select("key"), "key", "left_semi"), "near-open-texts")
    first = _first_shingles(apart, texts, threshold)
    met = cut(_meeting(first, None), "near-met")
    settle(_central_pairs(met, threshold), texts, "central")
    # Classes only grow: where one class met before, several do not meet now.
    met = met.drop("size")
    settle(_all_pairs(cut(_meeting(met, labels), "near-meeting"), threshold), texts, "rest")
    return labels


def _members(nodes: DataFrame) -> DataFrame:
    """``bucket, key, n, hub`` of the buckets with several nodes, ``hub`` being the smallest. Buckets are counted
    first by themselves: of the others, which are most, no row shuffles with its key."""
    buckets = nodes.select("key", "n", F.explode("bands").alias("bucket"))
    several = cut(buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").select("bucket"), "near-shared")
    buckets = buckets.filter(_among(several, several.count(), "bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("key").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    return cut(buckets.join(shared.select("bucket", "hub"), "bucket").select("bucket", "key", "n", "hub"), "near-members")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, text`` of the wanted rows."""
    rows = _holding(docs.select(row_key().alias("key"), "text"), wanted, wanted.count())
    return cut(rows.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key", "left_semi"), "near-texts")


def _first_pairs(member: DataFrame, threshold: float) -> DataFrame:
    """Every member of a bucket with the smallest one."""
    hubs = member.filter(F.col("key") == F.col("hub")).select("bucket", F.col("key").alias("hub_key"), F.col("n").alias("hub_n"))
    pairs = member.join(hubs, "bucket").filter("key <> hub_key")
    return _sized(pairs, threshold).select(F.col("key").alias("a"), F.col("hub_key").alias("b")).distinct()


def _apart(member: DataFrame, labels: DataFrame | None, name: str) -> DataFrame:
    """``bucket, key, n, label`` of the members of buckets that are not yet one class."""
    now = member.select("bucket", "key", "n", F.col("key").alias("label"))
    if labels is not None:
        now = member.join(labels, member["key"] == labels["node"], "left").select(
            "bucket", "key", "n", F.coalesce("label", "key").alias("label"))
    now = cut(now, f"{name}-now")
    several = now.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("bucket")
    return cut(now.join(cut(several, f"{name}-several"), "bucket", "left_semi"), name)


def _first_shingles(apart: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``token, key, n, label, pos, prev``: the rarest shingles of every text, ``pos`` counting them from 0, and the
    one before.

    Put the shingles of all texts in one order, each with the number of its
    occurrence in the text: by how many of the texts have it, so that a passage
    that very many have comes last. Two texts with a similarity of t or more
    share one of their first ``n - ceil(t n) + 1``, whatever the order is.
    """
    rows = texts.join(apart, "key").select("key", "n", "label", "text")

    def count(batches):
        hashes = WordHashes()
        for b in batches:
            parts = [np.unique(shingles(words_of(t), hashes)) for t in texts_of(b, "text")]
            found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["s", "n"])
        give_back()

    often = texts.select("text").mapInArrow(count, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n"))
    often = often.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "s").limit(MAX_FREQUENT).toArrow()
    keys, counts = (often.column(c).to_numpy().astype(np.int64) for c in ("s", "n"))
    order = np.argsort(keys.view(np.uint64))
    sent = rows.sparkSession.sparkContext.broadcast((keys.view(np.uint64)[order], counts[order]))

    def rarest(batches):
        hashes, (often, counts) = WordHashes(), sent.value
        for b in batches:
            rows_, tokens, places, before = [], [], [], []
            for i, t in enumerate(texts_of(b, "text")):
                s = np.sort(shingles(words_of(t), hashes))
                nth = np.arange(len(s)) - np.searchsorted(s, s)  # equal shingles, told apart by their number
                n = np.zeros(len(s), np.int64)
                if len(often):
                    place = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    n = np.where(often[place] == s, counts[place], 0)
                token = mix64(s + nth.astype(np.uint64) * GOLDEN)
                first = token[np.lexsort((token, nth, n))[:len(s) - math.ceil(threshold * len(s) - 1e-9) + 1]].view(np.int64)
                tokens.append(first)
                places.append(np.arange(len(first)))
                before.append(np.concatenate([first[:1], first[:-1]]))
                rows_.append(np.full(len(first), i, np.int64))
            at, *numbers = (pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (rows_, tokens, places, before))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in ("key", "n", "label")), *numbers], names=schema.names)
        give_back()

    zero = F.lit(0).cast("bigint")
    schema = rows.select("key", "n", "label", zero.alias("token"), zero.alias("pos"), zero.alias("prev")).schema
    return cut(rows.mapInArrow(rarest, schema), "near-rarest")


def _meeting(first: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of shingles at which different classes meet, with the number of texts that do, ``size``."""
    if labels is not None:
        first = first.join(labels, first["key"] == labels["node"], "left").select(
            "key", "n", F.coalesce(labels["label"], first["label"]).alias("label"), "token", "pos", "prev")
    groups = first.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
    return first.join(groups.filter("lo <> hi").select("token", "size"), "token")


def _enough(threshold: float) -> Column:
    """Whether two texts can be similar that share no shingle before this one: they can then share at most what is
    left of either."""
    return F.least(F.col("n") - F.col("pos"), F.col("hub_n") - F.col("hub_pos")) >= (
        F.col("n") + F.col("hub_n")) * (threshold / (1 + threshold)) - 1e-6


def _central_pairs(meeting: DataFrame, threshold: float) -> DataFrame:
    """At shingles where many texts meet, every text with the one that has the smallest share of rarer shingles."""
    many = cut(meeting.filter(F.col("size") >= MANY), "near-many")
    central = F.struct((F.col("pos") / F.col("n")).alias("share"), F.col("key").alias("hub_key"), F.col("n").alias("hub_n"),
                       F.col("pos").alias("hub_pos"), F.col("label").alias("hub_label"))
    hubs = many.groupBy("token").agg(F.min(central).alias("hub")).select("token", "hub.*")
    pairs = many.join(hubs, "token").filter("label <> hub_label").filter(_enough(threshold))
    return _two(pairs, threshold)


def _sides(many: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The larger and the smaller texts that can be similar, to be joined by ``token`` and ``step``.

    A text can share at most what is left of it from ``pos`` on, which bounds
    the partner's number of shingles. So texts meet by steps of that number, and
    one that has too little left for any partner meets none.
    """
    def step(x):
        return F.floor(F.log(x) / math.log(SIZE_STEP)).cast("int")

    most = (F.col("n") - F.col("pos") + 1e-6) * ((1 + threshold) / threshold) - F.col("n") + 1e-6  # of the partner's shingles
    least = F.greatest(F.col("n") * (threshold - 1e-9) - 1e-6, F.lit(1.0))
    upper = many.withColumn("lo", least).withColumn("hi", F.least(F.col("n").cast("double"), most)).filter("hi >= lo")
    upper = upper.withColumn("step", F.explode(F.sequence(step(F.col("lo")), step(F.col("hi"))))).select(
        "token", "step", "key", "n", "label", "pos", "prev")
    return upper, _hub(many.filter(most >= F.col("n")).withColumn("step", step(F.col("n"))), "step")


def _hub(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("token", *more, *[F.col(c).alias(f"hub_{c}") for c in ("key", "n", "label", "pos", "prev")])


def _all_pairs(meeting: DataFrame, threshold: float) -> DataFrame:
    """All pairs of texts of different classes that can be similar. A pair that shares the shingle before as well is
    given by that one."""
    new = (F.col("pos") == 0) | (F.col("hub_pos") == 0) | (F.col("prev") != F.col("hub_prev"))
    few, many = meeting.filter(F.col("size") < MANY), meeting.filter(F.col("size") >= MANY)
    pairs = few.join(_hub(few), "token").filter("label > hub_label")
    upper, lower = _sides(many, threshold)
    larger = (F.col("n") > F.col("hub_n")) | ((F.col("n") == F.col("hub_n")) & (F.col("label") > F.col("hub_label")))
    wide = upper.join(lower, ["token", "step"]).filter("label <> hub_label").filter(larger)
    columns = ["key", "n", "hub_key", "hub_n"]
    return _two(pairs.filter(new & _enough(threshold)).select(columns).unionByName(
        wide.filter(new & _enough(threshold)).select(columns)), threshold)


def _two(pairs: DataFrame, threshold: float) -> DataFrame:
    return _sized(pairs, threshold).select(F.greatest("key", "hub_key").alias("a"), F.least("key", "hub_key").alias("b")).distinct()


def _sized(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose numbers of shingles allow the similarity."""
    return pairs.filter(F.least("n", "hub_n") >= F.lit(threshold - 1e-9) * F.greatest("n", "hub_n"))


def near_report(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``. Of each class the smallest row stays, and of
    rows repeated with its id and text one."""
    classes = cut(near_classes(docs, **settings).select("key", "class_key")
                  .withColumn("rid", F.monotonically_increasing_id()), "near-classes")
    sizes = classes.groupBy("class_key").agg(
        F.count("*").alias("class_size"), F.min(F.struct("key", "rid")).alias("best"))
    joined = classes.join(cut(sizes, "near-sizes"), "class_key")
    return joined.select(F.col("key.id").alias("doc_id"), F.col("class_key.id").alias("class_id"), "class_size",
                         (F.col("rid") == F.col("best.rid")).alias("kept"))


def dedup_near(docs: DataFrame, **settings) -> DataFrame:
    """The documents that stay, one of each class, whole and with their own columns."""
    classes = near_classes(docs, **settings)
    gone = cut(classes.filter("key <> class_key").select("key").distinct(), "near-gone")
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("key"))
    repeated = cut(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "near-repeated")
    touched = gone.unionByName(repeated)
    maybe = _among(touched, touched.count())
    # A row that surely is neither gone nor repeated stays where it is; the others are looked up with their texts.
    # What is left of a class agrees in id and text: repeated rows, of which one stays.
    single = rows.filter(~maybe).select("row")
    several = rows.filter(maybe).groupBy("key").agg(F.first("row").alias("row")).join(gone, "key", "left_anti").select("row")
    return single.unionByName(several).select("row.*")
