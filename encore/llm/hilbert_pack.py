"""Packing of documents into sequences, similar ones side by side, along a space-filling curve.

A document's tokens are counted in the buckets of a hashed vector, which is
brought to length one and projected to a few dimensions. The place of the
projected point on a Hilbert curve is the document's key: points that are near
on the curve are near in space. Documents are range-sorted by key, and a task
lays those of its stretch of the curve end to end and cuts them every
``length`` ids. Only the last sequence of a stretch can be too short. It is
divided into sequences whose lengths are powers of two, its binary digits,
and those need no padding.

The ids are made once and stored beside the key; the sort moves them and not
the texts. Documents that agree in the key, copies above all, are dealt by a
salt, so a stretch of the curve is never more than its share of the rows.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import cut, mix64, prepare

LENGTH, END_ID = 2048, 1
#: Buckets of a hashed vector; dimensions of its projection and bits of each in the key.
BUCKETS, DIMENSIONS, BITS = 256, 4, 15
#: Bytes of ids in one stretch of the curve, about.
STRETCH_BYTES = 32 << 20
#: Ids whose vectors are counted at once.
COUNTED = 1 << 20


class Encoder:
    """The ids of a byte-level BPE tokenizer file of the ``tokenizers`` library.

    Its merges are in the order of the ids that they make, which is what
    ``tiktoken`` expects of ranks, and that library makes the same ids in a
    fifth of the time. A text that holds a special token's string goes through
    ``tokenizers`` itself, and so does everything if the file is of another kind.
    """

    #: The pattern of the byte-level pre-tokenizer (fixed value).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        import tiktoken
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [model["vocab"].get(a + b) for a, b in pairs]
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex", True) and not pre.get("add_prefix_space") and made == sorted(made, key=lambda x: x or 0))
        if not plain:
            return None
        byte_of = _byte_letters()
        special = set(self.special)
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        return tiktoken.Encoding("ranked", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, null counting as empty, and the end id."""
        if not text:
            ids = []
        elif self.fast is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array([*ids, END_ID], f"<u{self.width}")


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def projection() -> np.ndarray:
    """``BUCKETS`` x ``DIMENSIONS`` signs, by columns of length one."""
    cell = np.arange(BUCKETS * DIMENSIONS, dtype=np.uint64).reshape(BUCKETS, DIMENSIONS)
    return np.where(mix64(cell + np.uint64(0x5EED)) >> np.uint64(63), 1.0, -1.0) / np.sqrt(BUCKETS)


def points(ids: list[np.ndarray]) -> np.ndarray:
    """The projected vectors of several documents, each number between -1 and 1."""
    out, project = np.zeros((len(ids), DIMENSIONS)), projection()
    at = 0
    while at < len(ids):
        n, size = 1, len(ids[at])
        while at + n < len(ids) and n < 1024 and size + len(ids[at + n]) <= COUNTED:
            size += len(ids[at + n])
            n += 1
        flat = np.concatenate(ids[at:at + n]).astype(np.uint64)
        doc = np.repeat(np.arange(n), [len(x) for x in ids[at:at + n]])
        h = mix64(flat + np.uint64(1))
        sign = np.where(h >> np.uint64(63), 1.0, -1.0)
        counted = np.bincount(doc * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), sign, n * BUCKETS).reshape(n, BUCKETS)
        vector = np.sign(counted) * np.sqrt(np.abs(counted))  # frequent words count for less
        vector /= np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-300)
        out[at:at + n] = vector @ project
        at += n
    return out


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (n x dimensions, each below ``2 ** bits``), after Skilling (2004):
    the coordinates are turned into the transposed index in place, from the highest bit down."""
    x = [np.ascontiguousarray(c) for c in cells.astype(np.int64).T]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            on = (x[i] >> bit) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | (c ^ flip) >> bit & 1
    return key


def keys_of(ids: list[np.ndarray]) -> np.ndarray:
    """The curve keys of documents."""
    grid = np.floor((points(ids) + 1) * (1 << (BITS - 1))).astype(np.int64)
    return hilbert_key(np.clip(grid, 0, (1 << BITS) - 1))


def _encode(tokenizer: str):
    def run(batches):
        encoder = Encoder(tokenizer)
        for b in batches:
            ids = [encoder.encode(t) for t in b.column("text").to_pylist()]
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(keys_of(ids)), pa.array([len(i) for i in ids], pa.int64()),
                     pa.array([i.tobytes() for i in ids], pa.binary())], names=["doc_id", "key", "doc_tokens", "ids"])
    return run


class Sequences:
    """Cuts the documents of one stretch into sequences; holds the pieces of the open sequence only."""

    def __init__(self, length: int, first: int):
        self.length, self.number, self.used = length, first, 0
        self.open: list[tuple] = []  # (document, start in it, its length, ids)
        self.rows: list[tuple] = []

    def add(self, doc, n: int, ids: np.ndarray) -> None:
        at = 0
        while at < n:
            take = min(self.length - self.used, n - at)
            self.open.append((doc, at, n, ids[at:at + take]))
            self.used += take
            at += take
            if self.used == self.length:
                self.close([self.length])

    def close(self, sizes: list[int]) -> None:
        """End the open sequence, as sequences of these sizes."""
        sizes, offset = list(sizes), 0
        for doc, start, n, ids in self.open:
            at = 0
            while at < len(ids):
                take = min(sizes[0] - offset, len(ids) - at)
                part = ids[at:at + take].astype("<u4").tobytes()
                self.rows.append((doc, start + at, take, zlib.crc32(part), n, self.number, offset, part))
                at, offset = at + take, offset + take
                if offset == sizes[0]:
                    sizes.pop(0)
                    self.number, offset = self.number + 1, 0
        self.open, self.used = [], 0

    def finish(self) -> None:
        """End the stretch: what is left over, by its binary digits, needs no padding."""
        self.close([1 << b for b in range(self.used.bit_length() - 1, -1, -1) if self.used >> b & 1])

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, stretches: int | None = None,
                   with_ids: bool = True) -> DataFrame:
    """The pieces of all documents (``doc_id`` of any type, ``text``) in sequences of at most ``length`` ids.

    A row is one piece: ``doc_id``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32`` (of its ids as little-endian uint32),
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and, if asked
    for, ``ids`` (the same bytes). Every id, the end id of each document
    included, lies in one piece. Sequences are full but for fewer than twelve
    (at 2,048) at the end of a stretch, whose lengths are powers of two.

    Null and empty texts are the end id alone. Repeated rows and ids are
    documents of their own; a piece names its document by ``doc_id`` only. A
    long text fills sequences of its own. Equal documents have equal keys and
    come one after the other, in any order. Other columns are not read, and an
    empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    fields = [texts.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("doc_tokens", T.LongType()),
              T.StructField("ids", T.BinaryType())]
    width = Encoder(tokenizer).width
    encoded = cut(texts.mapInArrow(_encode(tokenizer), T.StructType(fields)), "packing-ids")
    if stretches is None:
        size = width * (encoded.agg(F.sum("doc_tokens").alias("n")).first()["n"] or 0)
        stretches = max(1, -(-size // STRETCH_BYTES), min(2 * spark.sparkContext.defaultParallelism, -(-size // (1 << 20))))
    salted = encoded.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    curve = salted.repartitionByRange(int(stretches), "key", "salt").sortWithinPartitions("key", "salt").drop("key", "salt")
    numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    out = [texts.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in numbers], T.StructField("ids", T.BinaryType())]

    def run(batches):
        from pyspark import TaskContext
        sequences = Sequences(length, TaskContext.get().partitionId() << 40)
        kind = None

        def rows():
            found = list(zip(*sequences.take())) or [()] * 8
            arrays = [pa.array(found[0], kind), *[pa.array(c, pa.int64()) for c in found[1:7]], pa.array(found[7], pa.binary())]
            batch = pa.RecordBatch.from_arrays(arrays, names=["doc_id", *numbers, "ids"])
            return batch if with_ids else batch.select(["doc_id", *numbers])

        for b in batches:
            kind = b.schema.field("doc_id").type
            ids = [np.frombuffer(i, f"<u{width}") for i in b.column("ids").to_pylist()]
            for doc, n, i in zip(b.column("doc_id").to_pylist(), b.column("doc_tokens").to_pylist(), ids):
                sequences.add(doc, n, i)
            yield rows()
        if kind is not None:
            sequences.finish()
            yield rows()

    return curve.mapInArrow(run, T.StructType(out if with_ids else out[:-1]))


def sequences_of(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, pieces`` of packed pieces: a group holds at most one sequence."""
    part = F.struct("offset", "doc_id", "start", "length", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    return grouped.select("sequence_id", F.aggregate("p", F.lit(0).cast("bigint"), lambda n, p: n + p["length"]).alias("n_tokens"),
                          F.aggregate("p", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"),
                          F.transform("p", lambda p: p.dropFields("ids")).alias("pieces"))
