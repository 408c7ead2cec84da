"""Hard negatives of anchors by exact integer products, several candidates to one multiplication.

Kronecker packing: the components of some candidates, made non-negative by a
bias, are laid into separate fields of one wide integer. A multiplication by
an anchor's component multiplies them all, and the sum over the components
holds every candidate's product in a field of its own, from which it is taken
out again, less what the biases added. Fields are as wide as the greatest sum
needs. The wide integers are kept in doubles, which are exact up to 53 bits
and multiply as matrices; where one field needs more, they are Python's, as
wide as it takes.

Anchors are sent in blocks of bounded size, and each block meets all rows in
two passes: the first finds an anchor's positives, the second the negatives of
each positive, whose scores the first has bounded. A task keeps the best few
per anchor; those of all tasks meet in a window per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import cut, prepare, scratch

POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Most anchors in a block, and most bytes of its components.
ANCHORS, ANCHOR_BYTES = 16_384, 16 << 20
#: Rows and anchors whose scores are held at once.
ROWS, AT_ONCE = 4_096, 512
EXACT = 53


class Packing:
    """How candidates are packed: ``d`` components, up to ``a`` in an anchor and ``b`` in a candidate."""

    def __init__(self, d: int, a: int, b: int):
        self.bias = b
        self.lift = d * a * 2 * b  # no field is below minus that
        self.width = max(1, (2 * self.lift).bit_length())
        self.exact = self.width <= EXACT
        self.fields = max(1, EXACT // self.width) if self.exact else 8
        self.wide = sum(self.lift << (self.width * f) for f in range(self.fields))

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """``d`` x ``ceil(n / fields)`` wide integers of n candidates; field f of column j is row ``f * columns + j``."""
        n, d = rows.shape
        columns = -(-n // self.fields)
        biased = np.zeros((self.fields * columns, d), np.int64 if self.exact else object)
        biased[:n] = (rows if self.exact else rows.astype(object)) + self.bias
        out = np.zeros((columns, d), biased.dtype)
        for f in range(self.fields):
            out += biased[f * columns:(f + 1) * columns] << (self.width * f)
        return np.ascontiguousarray(out.T.astype(np.float64) if self.exact else out.T)

    def products(self, anchors: np.ndarray, packed: np.ndarray, n: int) -> np.ndarray:
        """The exact inner products (anchors x n) of anchors and packed candidates."""
        if self.exact:
            total = (anchors.astype(np.float64) @ packed).astype(np.int64)
        else:
            total = anchors.astype(object).dot(packed)
        total = total + self.wide
        mask = (1 << self.width) - 1
        fields = [(total >> (self.width * f)) & mask for f in range(self.fields)]
        added = self.lift + self.bias * (anchors if self.exact else anchors.astype(object)).sum(axis=1)
        return (np.concatenate(fields, axis=1)[:, :n] - added[:, None]).astype(np.int64)


class Best:
    """The k best (score, then smaller id, then row) of each of n groups, over all that is offered."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, np.iinfo(np.int64).min)
        self.group, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def offer(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``scores`` (m x n): of the groups from ``first`` on and the candidates ``ids, rows``."""
        m, n = scores.shape
        if not m or not n:
            return
        good = allowed & (scores >= self.least[first:first + m, None])
        if n > 2 * self.k and np.count_nonzero(good) > 4 * self.k * m:
            shown = np.where(good, scores, np.iinfo(np.int64).min)
            kth = np.partition(shown, n - self.k, axis=1)[:, n - self.k]
            good &= scores >= kth[:, None]
        g, c = np.nonzero(good)
        if not g.size:
            return
        mine = (self.group >= first) & (self.group < first + m)
        group = np.concatenate([self.group[mine], g + first])
        score = np.concatenate([self.score[mine], scores[g, c]])
        id_, row = np.concatenate([self.id[mine], ids[c]]), np.concatenate([self.row[mine], rows[c]])
        order = np.lexsort((row, id_, ~score, group))  # ~x falls as x rises, and has no overflow
        group, score, id_, row = group[order], score[order], id_[order], row[order]
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        nth = np.arange(len(group)) - np.repeat(begins, np.diff([*begins, len(group)]))
        last = nth == self.k - 1
        self.least[group[last]] = score[last]
        left = nth < self.k
        others = ~mine
        self.group, self.score = np.concatenate([self.group[others], group[left]]), np.concatenate([self.score[others], score[left]])
        self.id, self.row = np.concatenate([self.id[others], id_[left]]), np.concatenate([self.row[others], row[left]])


def _matrix(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column as a matrix; short ones are filled with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == d).all():
        return flat.reshape(len(lengths), d)
    out = np.zeros((len(lengths), d), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _ids(column: pa.Array) -> np.ndarray:
    """Ids to order by; a null one is last."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _blocks(batches):
    """Batches joined to blocks of at least ``ROWS`` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(t: pa.Table, name: str) -> pa.Array:
    return t.column(name).combine_chunks() if not t.column(name).num_chunks == 1 else t.column(name).chunk(0)


FOUND = "anchor_row bigint, place int, id bigint, row bigint, score bigint"


def _emitted(best: Best, anchor: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor[best.group]), pa.array(place[best.group].astype(np.int32)), pa.array(best.id), pa.array(best.row),
         pa.array(best.score)], names=["anchor_row", "place", "id", "row", "score"])


def _positives(sent, d: int, packing: Packing, k: int):
    """Per task and anchor, the k best rows of the same label."""
    def run(batches):
        block = sent.value
        best = Best(len(block["row"]), k)
        for t in _blocks(batches):
            vectors, labels = _matrix(_column(t, "vector"), d), _column(t, "label").to_numpy(zero_copy_only=False)
            ids, rows = _ids(_column(t, "vec_id")), _column(t, "rid").to_numpy(zero_copy_only=False)
            for label in np.unique(labels):
                lo, hi = np.searchsorted(block["label"], [label, label + 1])  # anchors are sorted by label
                mine = np.flatnonzero(labels == label)
                if lo == hi:
                    continue
                packed = packing.pack(vectors[mine])
                for at in range(lo, hi, AT_ONCE):
                    to = min(at + AT_ONCE, hi)
                    scores = packing.products(block["vector"][at:to], packed, len(mine))
                    best.offer(at, scores, block["row"][at:to, None] != rows[mine][None, :], ids[mine], rows[mine])
        yield _emitted(best, block["row"], np.zeros(len(block["row"])))
    return run


def _negatives(sent, d: int, packing: Packing, k: int):
    """Per task, anchor and positive, the k best rows of other labels between the positive's bounds."""
    def run(batches):
        block = sent.value
        n = len(block["row"])
        most = block["low"].shape[1]
        best = [Best(n, k) for _ in range(most)]
        for t in _blocks(batches):
            vectors, labels = _matrix(_column(t, "vector"), d), _column(t, "label").to_numpy(zero_copy_only=False)
            ids, rows = _ids(_column(t, "vec_id")), _column(t, "rid").to_numpy(zero_copy_only=False)
            packed = packing.pack(vectors)
            for at in range(0, n, AT_ONCE):
                to = min(at + AT_ONCE, n)
                scores = packing.products(block["vector"][at:to], packed, len(rows))
                other = block["label"][at:to, None] != labels[None, :]
                for place in range(most):
                    fits = (scores >= block["low"][at:to, place, None]) & (scores <= block["high"][at:to, place, None])
                    best[place].offer(at, scores, other & fits, ids, rows)
        for place in range(most):
            yield _emitted(best[place], block["row"], np.full(n, place))
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k per anchor and place, numbered by ``nth``. The tasks' best are cut to k before the shuffle as well."""
    w = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, block: int = ANCHORS) -> DataFrame:
    """For every anchor and each of its positives, the hardest negatives.

    ``rows``: ``vec_id`` (integer), ``label`` (integer), ``vector`` (integers);
    a row takes part unless its label, its vector or a component is null.
    ``anchor`` tells the anchors. An anchor's positives are its first
    ``positives`` other rows of the same label, by score (the inner product
    with the anchor, exact) from the highest, ties by smaller ``vec_id``. A
    positive's negatives are the first ``negatives`` rows of other labels with
    ``low * p <= 100 * score <= high * p``, p being the positive's score.

    Result: ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``. Rows that repeat an id are rows of their own, also as an
    anchor's positive; a null id comes after all others and is no anchor unless
    ``anchor`` says so. Vectors of different lengths count as filled with zeros.
    An anchor without positives, or without negatives between the bounds, and
    an empty table give no rows. Scores beyond 63 bits are an error.
    """
    spark = prepare(rows.sparkSession)
    known = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    table = rows.withColumn("anchor", F.coalesce(anchor, F.lit(False))).filter(known).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("vector").cast("array<bigint>").alias("vector"), "anchor", F.monotonically_increasing_id().alias("rid"))
    table = cut(table, "negatives-rows")
    peak = F.aggregate("vector", F.lit(0).cast("bigint"), lambda m, x: F.greatest(m, F.abs(x)))
    sizes = table.agg(F.max(F.size("vector")).alias("d"), F.max(peak).alias("b"), F.max(F.when(F.col("anchor"), peak)).alias("a"),
                      F.count(F.when(F.col("anchor"), 1)).alias("n")).first()
    out = T._parse_datatype_string("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                                   "negative_score bigint")
    if not sizes["n"]:
        return spark.createDataFrame([], out)
    d, packing = max(1, sizes["d"]), Packing(max(1, sizes["d"]), sizes["a"], sizes["b"])
    if d * sizes["a"] * sizes["b"] >= 1 << 63:
        raise ValueError("an inner product may need more than 63 bits")
    blocks = -(-sizes["n"] // max(1, min(block, ANCHOR_BYTES // (8 * d))))
    path = scratch(spark, "negatives")
    anchors = table.filter("anchor")
    for number in range(blocks):
        mine = anchors.filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == number)
        _block(table, mine, d, packing, positives, negatives, low, high, f"{path}/block={number}")
    return spark.read.schema(out).parquet(*[f"{path}/block={number}" for number in range(blocks)])


def _block(table: DataFrame, mine: DataFrame, d: int, packing: Packing, positives: int, negatives: int, low: int, high: int,
           path: str) -> None:
    """The negatives of one block of anchors, written to ``path``."""
    spark = table.sparkSession
    held = mine.select("rid", "vec_id", "label", "vector").toArrow().combine_chunks().sort_by([("label", "ascending"), ("rid", "ascending")])
    rids = _column(held, "rid").to_numpy().astype(np.int64)
    block = {"row": rids, "label": _column(held, "label").to_numpy().astype(np.int64), "vector": _matrix(_column(held, "vector"), d)}
    candidates = table.select("vec_id", "label", "vector", "rid")
    sent = spark.sparkContext.broadcast(block)
    found = candidates.mapInArrow(_positives(sent, d, packing, positives), FOUND)
    near = cut(_first(found, positives), "negatives-positives")
    # At most ``positives`` rows for each of the block's anchors.
    first = near.select("anchor_row", "nth", "score").toArrow()
    at = np.argsort(rids)[np.searchsorted(np.sort(rids), first.column("anchor_row").to_numpy())]
    place, p = first.column("nth").to_numpy() - 1, [int(x) for x in first.column("score").to_numpy()]
    block["low"] = np.ones((len(rids), positives), np.int64)
    block["high"] = np.zeros((len(rids), positives), np.int64)  # no positive: nothing fits
    block["low"][at, place] = [-(-low * x // 100) for x in p]
    block["high"][at, place] = [high * x // 100 for x in p]
    again = spark.sparkContext.broadcast(block)
    hard = _first(candidates.mapInArrow(_negatives(again, d, packing, negatives), FOUND), negatives)
    none = np.iinfo(np.int64).max
    own = near.select("anchor_row", (F.col("nth") - 1).cast("int").alias("place"), F.col("row").alias("positive_row"),
                      F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    ids = mine.select(F.col("rid").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    rows = hard.join(own, ["anchor_row", "place"]).join(ids, "anchor_row")
    rows.select("anchor_id", F.nullif("positive_id", F.lit(none)).alias("positive_id"), F.col("nth").cast("int").alias("rank"),
                F.nullif("id", F.lit(none)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.parquet(path)
    sent.unpersist()
    again.unpersist()
