"""Token ids as files of length-delimited binary records, with an offset index.

A record is framed as ``length (uint64) | masked CRC of the length (uint32) |
payload | masked CRC of the payload (uint32)``, all little-endian. The mask
rotates the CRC-32 by 15 bits and adds a constant, so that a file which itself
holds checksums does not confuse them. The payload is a flag byte, the
document id (int64) and the token ids (uint16 where the vocabulary allows,
else uint32).

Documents are range-partitioned by id: one task sorts, encodes and writes one
file. The file has a name that no other attempt of the task uses; the index, a
table that Spark commits once per task, names the files that count and every
record's place in them, so that lost executors and repeated tasks leave at
most a file that nothing refers to. The index is read by itself, in any order,
for shuffled reads.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.common import give_back, prepare, scratch

#: Fixed values of the framing.
MASK_DELTA, MASK_ROTATE = 0xA282EAD8, 15
#: Words whose ids a task keeps; twice as many at most.
CACHED_WORDS = 100_000
#: Lower-cased runs of letters whose ids are kept, twice as many at most, and runs of punctuation.
CACHED_RUNS, CACHED_MARKS = 150_000, 10_000
#: Bytes of text to one file, about.
FILE_BYTES = 64 << 20
#: First characters of a text by which rows of a repeated id are dealt over files.
PREFIX = 64
#: Bytes of ids in one batch that a reader hands on.
READ_BYTES = 4 << 20
#: The end-of-document id.
END_ID = 1

INDEX = "doc_id bigint, file string, nth bigint, offset bigint, length bigint, n_tokens bigint"


def masked(crc: int) -> int:
    return (((crc >> MASK_ROTATE) | (crc << (32 - MASK_ROTATE))) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), payload,
                     struct.pack("<I", masked(zlib.crc32(payload)))))


def read_record(stream) -> bytes | None:
    """The next payload of a stream; None at its end. Raises ValueError for a damaged record."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(zlib.crc32(head[:8])):
        raise ValueError("damaged length of a record")
    size = struct.unpack("<Q", head[:8])[0]
    body = stream.read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked(zlib.crc32(body[:size])):
        raise ValueError("damaged record")
    return body[:size]


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack("<Bq", width | (128 if doc_id is None else 0), doc_id or 0) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, "<u2" if flags & 127 == 2 else "<u4", offset=9)
    return None if flags & 128 else doc_id, ids


class WordEncoder:
    """Encodes texts with a tokenizer whose pre-tokens never cross white space.

    Such a tokenizer gives a text the ids of its white-space separated words,
    one after the other. A word of plain letters, maybe between punctuation, has
    those of its runs, and the ids of frequent runs in lower case are kept; so are
    those of frequent other words. What is new in a batch is encoded together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: Whether an id ends a pre-token; none if the vocabulary does not say.
        self.ends = None
        if suffix:
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Ids of runs of letters, and of runs of punctuation (None: not apart from letters beside it).
        self.runs: dict[str, bytes] = {}
        self.older_runs: dict[str, bytes] = {}
        self.marks: dict[str, bytes | None] = {"": b""}
        #: Words of plain letters between punctuation; none if their ids cannot be told apart.
        self.simple = None
        special = self.tokenizer.get_added_tokens_decoder().values()
        if suffix and self.tokenizer.pre_tokenizer and all("<|" in t.content for t in special):
            if plain := "".join(filter(self.is_plain, map(chr, LETTER_CODES))):
                self.simple = f"^(?P<a>{MARKS}*)(?P<run>[{plain}]+)(?P<b>{MARKS}*)$"

    def normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def is_plain(self, c: str) -> bool:
        """Whether the tokenizer takes a character as its lower case, and that as part of a run of letters."""
        low = c.lower()
        same = c.isalpha() and self.normal(c) == low == pc.utf8_lower(pa.scalar(c)).as_py()
        return same and self.cut_at(f"a{low}a") == [(0, 3)]

    def cut_at(self, text: str) -> list[tuple[int, int]]:
        return [at for _, at in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.normal(text))]

    def mark(self, run: str) -> bytes | None:
        """The ids of a run of punctuation; None if it is not a pre-token of its own beside letters."""
        if run not in self.marks:
            if len(self.marks) >= CACHED_MARKS:
                self.marks = {"": b""}
            n = len(run)
            apart = "<|" not in run and self.cut_at(f"{run}ab") == [(0, n), (n, n + 2)] and (
                self.cut_at(f"ab{run}") == [(0, 2), (2, n + 2)])
            self.marks[run] = self.plain(run) if apart else None
        return self.marks[run]

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, f"<u{self.width}").tobytes()

    def pieces(self, word: str) -> int:
        """Number of pre-tokens of a word."""
        simple = LETTERS.fullmatch(word)
        if simple and simple[2].isalpha():
            return 1 + bool(simple[1]) + bool(simple[3])
        normal = self.normal(word)
        return 1 if normal.isalpha() else len(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def cuts(self, words: list[str], done) -> np.ndarray:
        """Where the ids of each word begin, and the end of the last, in those of the words as one text."""
        ids = np.array(done.ids, np.int64)
        if self.ends is not None:
            after = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum([self.pieces(w) for w in words])
            if len(after) == last[-1] and after[-1] == len(ids):
                return np.concatenate([[0], after[last - 1]])
        offsets = self.tokenizer.encode(" ".join(words), add_special_tokens=False).offsets
        begin = np.cumsum([0, *[len(w) + 1 for w in words]])
        return np.searchsorted(np.fromiter((a for a, _ in offsets), np.int64, len(ids)), begin)

    def learn(self, words: list[str]) -> None:
        """Encode new words as one text, and cut the ids."""
        if len(self.recent) + len(words) > CACHED_WORDS:
            self.older, self.recent = self.recent, {}
        simple = []
        for w in words:
            if "<|" in w or not w:
                self.recent[w] = self.plain(w)
            else:
                simple.append(w)
        for at in range(0, len(simple), 10_000):
            part = simple[at:at + 10_000]
            done = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            raw, cuts = np.array(done.ids, f"<u{self.width}").tobytes(), (self.cuts(part, done) * self.width).tolist()
            self.recent.update((w, raw[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))

    def known_runs(self, wanted: list[str]) -> list[bytes]:
        """The ids of distinct runs of plain letters in lower case, each of them one pre-token."""
        if len(self.runs) + len(wanted) > CACHED_RUNS:
            self.older_runs, self.runs = self.runs, {}
        held, older, new = self.runs, self.older_runs, []
        found = list(map(held.get, wanted))
        for i, ids in enumerate(found):
            if ids is None:
                ids = found[i] = older.get(wanted[i])
                if ids is None:
                    new.append(i)
                else:
                    held[wanted[i]] = ids
        for at in range(0, len(new), 10_000):
            which = new[at:at + 10_000]
            part = [wanted[i] for i in which]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, f"<u{self.width}")
            after = np.flatnonzero(self.ends[ids]) + 1
            if len(after) == len(part) and after[-1] == len(ids):
                raw, cuts = ids.tobytes(), [0, *(after * self.width).tolist()]
                cut = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                cut = [self.plain(run) for run in part]
            for i, run, one in zip(which, part, cut):
                found[i] = held[run] = one
        return found

    def lists(self, found: list[bytes]) -> tuple[pa.ListArray, np.ndarray]:
        """Ids as a column of lists, and the length of each."""
        length = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        values = pa.array(np.frombuffer(b"".join(found), f"<u{self.width}"))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), values), length

    def of_words(self, words: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """``lists`` of distinct words."""
        if not self.simple:
            return self.lists(self.known(words.to_pylist()))
        parts = pc.extract_regex(words, self.simple)
        first, run, last = parts.flatten()
        first, last = first.dictionary_encode(), last.dictionary_encode()
        firsts, lasts = ([self.mark(m) for m in c.dictionary.to_pylist()] for c in (first, last))
        # Which words are made of runs; null is the place of a word that is not, and the end of the lists.
        first_at, last_at = (c.indices.fill_null(len(c.dictionary)).to_numpy() for c in (first, last))
        simple = np.ones(len(words), bool)
        for found, at in ((firsts, first_at), (lasts, last_at)):
            simple &= np.array([ids is not None for ids in found] + [False])[at]
        run = pc.utf8_lower(run.filter(pa.array(simple))).dictionary_encode()
        runs = self.known_runs(run.dictionary.to_pylist())
        rest = self.known(words.filter(pa.array(~simple)).to_pylist())
        at = np.zeros((len(words), 3), np.int64)
        at[simple, 0] = 1 + first_at[simple]
        at[simple, 1] = 1 + len(firsts) + run.indices.to_numpy()
        at[simple, 2] = 1 + len(firsts) + len(runs) + last_at[simple]
        at[~simple, 0] = 1 + len(firsts) + len(runs) + len(lasts) + np.arange(len(rest))
        table, length = self.lists([b"", *(ids or b"" for ids in firsts), *runs, *(ids or b"" for ids in lasts), *rest])
        length = length[at].sum(axis=1)
        values = table.take(pa.array(at.reshape(-1))).flatten()
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), values), length

    def known(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        held, older = self.recent, self.older
        found = list(map(held.get, words))
        new = []
        for i, ids in enumerate(found):
            if ids is None:
                ids = found[i] = older.get(words[i])
                if ids is None:
                    new.append(i)
                else:
                    held[words[i]] = ids
        if new:
            self.learn([words[i] for i in new])
            for i in new:
                found[i] = self.recent[words[i]]
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text of a column, null counting as empty.

        Arrow splits the column, numbers its distinct words and those words' distinct
        runs; only runs are looked up one by one, and ids are gathered in their order.
        """
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]")  # Arrow splits at these, tokenizers do not call them white space
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        words = split.flatten().dictionary_encode()
        lists, length = self.of_words(words.dictionary)
        raw = memoryview(lists.take(words.indices).flatten().to_numpy(zero_copy_only=False).tobytes())
        at = words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(length[at])])[np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))]
        cuts = [0, *(ends * self.width).tolist()]
        out = [bytes(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.plain(texts[i].as_py())
        return out


#: Letters, maybe between ASCII punctuation; without apostrophes and the one letter that has two in lower case.
LETTERS = re.compile(r"([!-&(-/:-@\[-`{-~]*)([^\W\d_\u0130]+)([!-&(-/:-@\[-`{-~]*)")
#: ASCII punctuation without apostrophes, and the codes of Latin and Cyrillic letters (no case that depends on the place).
MARKS, LETTER_CODES = r"[!-&(-/:-@\[-`{-~]", [*range(0x41, 0x250), *range(0x400, 0x530)]
#: The encoder of a Python worker, which serves one task after the other.
_ENCODER: dict[str, WordEncoder] = {}


def encoder_of(tokenizer: str) -> WordEncoder:
    """The worker's encoder, with the ids of words that it has kept."""
    if tokenizer not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[tokenizer] = WordEncoder(tokenizer)
    return _ENCODER[tokenizer]


def file_system(path: str):
    """(pyarrow file system, path in it) of a folder that the cluster shares."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def write_records(docs: DataFrame, tokenizer: str, name: str = "tokens", files: int | None = None) -> tuple[str, DataFrame]:
    """Encode and write ``docs`` in ascending ``doc_id`` order (null first, repeated ids by their text).

    A repeated id may fill several files, dealt by the first ``PREFIX``
    characters of the text. Where those agree too, the files take the texts by
    a hash, and rows repeated with id and text in any order.

    Returns the folder of the files and the index table. Null text counts as
    empty: its record has the end id alone. An empty table gives one empty
    index. Other columns are not written.
    """
    spark = prepare(docs.sparkSession)
    folder = scratch(spark, name)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if files is None:
        size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
        files = max(1, -(-size // FILE_BYTES))
        files = max(files, min(spark.sparkContext.defaultParallelism * 2, -(-size // (1 << 20))))
    salted = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    ordered = salted.repartitionByRange(
        int(files), F.col("doc_id").asc_nulls_first(), F.substring("text", 1, PREFIX), F.xxhash64("text"), "salt").drop(
        "salt").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    schema = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("nth", pa.int64()), ("offset", pa.int64()),
                        ("length", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        from pyspark import TaskContext
        files_, base = file_system(f"{folder}/records")
        files_.create_dir(base, recursive=True)
        number = TaskContext.get().partitionId()
        file = f"{number:08d}-{uuid.uuid4().hex}.rec"
        encoder = encoder_of(tokenizer)
        end = np.array([END_ID], f"<u{encoder.width}").tobytes()
        offset = nth = 0
        with files_.open_output_stream(f"{base}/{file}") as out:
            for b in batches:
                index = []
                ids_of = encoder.encode(b.column("text"))
                for doc_id, ids in zip(b.column("doc_id").to_pylist(), ids_of):
                    record = frame(pack(doc_id, ids + end, encoder.width))
                    out.write(record)
                    index.append((doc_id, file, nth, offset, len(record), len(ids) // encoder.width + 1))
                    offset += len(record)
                    nth += 1
                if index:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), schema.types)],
                                                     schema=schema)
        give_back()

    ordered.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return folder, spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` of all records, read back from the files.

    ``start`` counts the ids of all records before, in file order; the CRC-32
    and ``ids`` take every id as a little-endian uint32. A task reads whole
    files from front to back; only the totals of the files meet in one place.
    """
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    files = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("start"))
    parts = max(1, min(totals.count(), 100_000))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("ids", pa.binary())][:4 + with_ids])

    def run(batches):
        files_, base = file_system(f"{folder}/records")
        for b in batches:
            for file, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist()):
                with files_.open_input_stream(f"{base}/{file}", buffer_size=1 << 20) as stream:
                    rows, held = [], 0
                    while (payload := read_record(stream)) is not None:
                        doc_id, ids = unpack(payload)
                        raw = ids.astype("<u4").tobytes()
                        rows.append((doc_id, start, len(ids), zlib.crc32(raw), raw)[:len(schema)])
                        start += len(ids)
                        held += len(raw)
                        if held >= READ_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                             schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                         schema=schema)

    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return files.repartition(parts, "file").mapInArrow(run, columns)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """``doc_id, ids`` in a random order: the index is shuffled, and each record is read at its offset."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    order = F.xxhash64(F.lit(seed), "file", "nth")

    def run(batches):
        files_, base = file_system(f"{folder}/records")
        open_: dict[str, object] = {}
        try:
            for b in batches:
                ids_, docs = [], []
                for file, offset in zip(b.column("file").to_pylist(), b.column("offset").to_pylist()):
                    if file not in open_:
                        if len(open_) >= 64:
                            open_.pop(next(iter(open_))).close()
                        open_[file] = files_.open_input_file(f"{base}/{file}")
                    open_[file].seek(offset)
                    doc_id, ids = unpack(read_record(open_[file]))
                    docs.append(doc_id)
                    ids_.append(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids_, pa.binary())],
                                                 names=["doc_id", "ids"])
        finally:
            for f in open_.values():
                f.close()

    shuffled = index.select("file", "offset", order.alias("at")).orderBy("at").select("file", "offset")
    return shuffled.mapInArrow(run, "doc_id bigint, ids binary")
