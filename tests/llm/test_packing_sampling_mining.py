"""Curve packing, importance resampling and hard negatives against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge import documents, edge_docs, edge_rows
from pyspark.sql import functions as F

from encore.llm import hilbert_pack, kronecker_negatives, ngram_resample

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- packing along the curve

@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTE_BPE)


def test_ids_are_those_of_the_tokenizers_library(plain):
    rng = random.Random(5)
    encoder = hilbert_pack.Encoder(BYTE_BPE)
    assert encoder.fast is not None and encoder.width == 2
    texts = [t or "" for _, t, _, _ in documents()]
    kinds = [range(32, 127), range(0, 256), range(0x400, 0x500), range(0x4e00, 0x4f00), range(0x1F600, 0x1F640), (9, 10, 13, 32, 160, 0x3000, 65, 39, 48)]
    texts += ["".join(chr(rng.choice(rng.choice(kinds))) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "we'll they're I'd  x\n\n y\t\tz "]
    for t in texts:
        assert encoder.encode(t).tolist() == [*plain.encode(t, add_special_tokens=False).ids, 1], t
    assert encoder.encode(None).tolist() == [1]


def test_other_tokenizers_go_through_the_library():
    encoder = hilbert_pack.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.fast is None
    assert encoder.encode("One two").tolist() == [*encoder.tokenizer.encode("One two", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("dimensions,bits", [(2, 5), (3, 3), (4, 2)])
def test_next_cells_of_the_curve_are_neighbours(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    key = hilbert_pack.hilbert_key(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    along = cells[np.argsort(key)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length,stretches", [(2048, None), (64, 3)])
def test_pieces_hold_every_id_once(spark, plain, length, stretches):
    rows = edge_rows()
    pieces = hilbert_pack.pack_documents(edge_docs(spark), BYTE_BPE, length, stretches).collect()
    expected = collections.Counter((r[0], tuple([*plain.encode(r[1] or "", add_special_tokens=False).ids, 1])) for r in rows)
    ids_of = {(r[0], r[1] or ""): [*plain.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    by_sequence, by_id = collections.defaultdict(list), collections.Counter()
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] > 0 and zlib.crc32(p["ids"]) == p["ids_crc32"]
        assert any(d == p["doc_id"] and len(i) == p["doc_tokens"] and i[p["start"]:p["start"] + p["length"]] == ids.tolist()
                   for (d, _), i in ids_of.items())
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_id[p["doc_id"]] += p["length"]
    assert by_id == collections.Counter({d: 0 for d in by_id}) + sum(
        (collections.Counter({d: len(i) * n}) for (d, i), n in expected.items()), collections.Counter())
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or at < length and at & (at - 1) == 0  # no padding
    short = sum(sum(n for _, n in parts) < length for parts in by_sequence.values())
    assert short <= (stretches or 8) * length.bit_length()


def test_a_documents_pieces_follow_each_other(spark, plain):
    rows = [(i, t) for i, (_, t, _, _) in enumerate(documents())]
    pieces = hilbert_pack.pack_documents(spark.createDataFrame(rows, "doc_id string, text string"), BYTE_BPE)
    by_doc = collections.defaultdict(list)
    for p in pieces.collect():
        by_doc[p["doc_id"]].append(p)
    assert len(by_doc) == len(rows)
    for i, t in rows:
        found = sorted(by_doc[str(i)], key=lambda p: p["start"])
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        assert b"".join(p["ids"] for p in found) == np.array(ids, "<u4").tobytes()
        assert [p["start"] for p in found] == [0, *itertools.accumulate(p["length"] for p in found)][:-1]
    whole = hilbert_pack.sequences_of(pieces).collect()
    assert all(len(s["ids"]) == 4 * s["n_tokens"] and s["n_tokens"] <= 2048 for s in whole)
    assert sum(s["n_tokens"] for s in whole) == sum(p["doc_tokens"] for p in by_doc_first(by_doc))


def by_doc_first(by_doc):
    return [min(ps, key=lambda p: p["start"]) for ps in by_doc.values()]


def test_neighbours_on_the_curve_are_similar():
    encoder = hilbert_pack.Encoder(BYTE_BPE)
    ids = [encoder.encode(t) for _, t, _, _ in documents()]
    at, key = hilbert_pack.points(ids), hilbert_pack.keys_of(ids)
    assert np.abs(at).max() <= 1
    along = at[np.argsort(key, kind="stable")]
    near = np.linalg.norm(np.diff(along, axis=0), axis=1).mean()
    far = np.linalg.norm(np.diff(at[np.random.default_rng(1).permutation(len(at))], axis=0), axis=1).mean()
    assert near < 0.6 * far
    copies = hilbert_pack.keys_of([ids[0], ids[1], ids[0]])
    assert copies[0] == copies[2] != copies[1]


def test_packing_an_empty_table(spark):
    assert hilbert_pack.pack_documents(edge_docs(spark, []), BYTE_BPE).count() == 0


# ---------------------------------------------------------------- importance resampling

def ngrams(text, shortest, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i:i + n]) for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)], len(w)


def resampled(rows, target, shortest, longest, buckets, min_words, percent, seed):
    """(doc_id, n_features, weight, score, rank) of every row."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    count = lambda texts: collections.Counter(bucket(f) for t in texts for f in ngrams(t, shortest, longest)[0])
    s, t = count([r[1] for r in rows]), count(target)
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    out = []
    for doc_id, text in rows:
        f, words = ngrams(text, shortest, longest)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, words])
    large = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(large[:percent * len(large) // 100], 1):
        r[4] = n
    return collections.Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("shortest,longest,min_words,percent", [(1, 1, 20, 10), (1, 3, 1, 60), (2, 2, 0, 100), (1, 1, 5000, 50)])
def test_resampling_against_brute_force(spark, shortest, longest, min_words, percent):
    rows = [(d, t) for d, t, _, _ in documents()] + [(r[0], r[1]) for r in edge_rows()]
    rows = [(None if d is None else d, t) for d, t in rows]
    target = ["One two three! four", None, "", "alpha7 beta2 über", rows[3][1]]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, score string")
    got = ngram_resample.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), None, shortest, longest, 997,
                                  min_words, percent, "7")
    assert got.select("row.*").columns == docs.columns
    found = collections.Counter(tuple(r) for r in got.select("row.doc_id", "n_features", "weight", "score", "rank").collect())
    assert found == resampled(rows, target, shortest, longest, 997, min_words, percent, "7")


def test_resampling_of_empty_tables(spark):
    docs, none = edge_docs(spark), spark.createDataFrame([], "text string")
    assert ngram_resample.resample(edge_docs(spark, []), docs).count() == 0
    got = ngram_resample.resample(docs, none, ["doc_id", "score"]).select("row.*", "rank")
    assert got.columns == ["doc_id", "score", "rank"] and got.count() == len(edge_rows())


def test_overlapped_spans():
    line = ngram_resample.collapsed("One, two;three\nÉé".encode())
    assert line == "one two three Éé".encode()
    found = [line[a:b].decode() for a, b in ngram_resample.spans("One, two;three\nÉé".encode(), 1, 3)]
    assert found == ["one", "two", "three", "Éé", "one two", "two three", "three Éé", "one two three", "two three Éé"]
    assert ngram_resample.spans(None) == ngram_resample.spans(b"?!") == []
    many = b"word " * 200_000
    assert len(ngram_resample.spans(many, 2, 2)) == 199_999


def test_ranks_over_several_tasks(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same words " * 12).alias("text"))
    docs = docs.unionByName(spark.range(2500).select(F.lit(77).cast("bigint").alias("doc_id"), F.lit("same words " * 12).alias("text")))
    got = ngram_resample.resample(docs.repartition(9), docs.limit(1), ["doc_id"], percent=50).filter("rank is not null")
    ranks = [(r["rank"], -r["score"], r["doc_id"]) for r in got.select("rank", "score", "row.doc_id").orderBy("rank").collect()]
    assert [r[0] for r in ranks] == list(range(1, 3751))
    assert [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)


# ---------------------------------------------------------------- hard negatives

@pytest.mark.parametrize("a,b,d", [(150, 157, 64), (1, 0, 3), (3, 3, 2), (1 << 20, 1 << 22, 64), (1 << 28, 1 << 30, 5)])
def test_packed_products_are_exact(a, b, d):
    rng = np.random.default_rng(a + d)
    anchors, rows = rng.integers(-a, a, (7, d), endpoint=True), rng.integers(-b, b, (23, d), endpoint=True)
    anchors[0], rows[0], rows[1] = a, b, -b
    packing = kronecker_negatives.Packing(d, a, b)
    expected = anchors.astype(object).dot(rows.astype(object).T)
    assert (packing.products(anchors, packing.pack(rows), len(rows)) == expected).all()
    assert packing.fields > 1 or packing.width > kronecker_negatives.EXACT // 2


def mined(rows, positives, negatives, low, high, anchor):
    known = [(i, v, l, x) for i, (v, l, x) in enumerate(rows) if l is not None and x is not None and None not in x]
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    last = lambda v: (v is None, v or 0)
    out = collections.Counter()
    for i, v, l, x in known:
        if not anchor(v):
            continue
        scored = sorted(((dot(x, y), w, m) for j, w, m, y in known if j != i), key=lambda s: (-s[0], last(s[1])))
        for p, w, _ in [s for s in scored if s[2] == l][:positives]:
            fits = [s for s in scored if s[2] != l and low * p <= 100 * s[0] <= high * p][:negatives]
            out.update((v, w, n, s[1], p, s[0]) for n, s in enumerate(fits, 1))
    return out


@pytest.mark.parametrize("scale,block,low,high", [(40, 16_384, 30, 90), (3, 2, 0, 100), (1 << 29, 16_384, 30, 90)])
def test_negatives_against_brute_force(spark, monkeypatch, scale, block, low, high):
    monkeypatch.setattr(kronecker_negatives, "ROWS", 50)
    monkeypatch.setattr(kronecker_negatives, "AT_ONCE", 3)
    rng = random.Random(scale)
    rows = [(i, rng.randrange(3), [rng.randint(-scale, scale) for _ in range(4)]) for i in range(300)]
    rows += rows[:40] + [(None, 1, [1, 2, 3, 4]), (None, 0, [0, 0, 0, 0]), (1000, None, [1, 1, 1, 1]), (1001, 1, None),
                         (1002, 2, [1, None, 1, 1]), (1003, 1, []), (1004, 1, [scale]), (2000, 9, [1, 1, 1, 1])]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, vector array<bigint>").repartition(3)
    got = kronecker_negatives.hard_negatives(table, F.col("vec_id") % 20 == 0, 3, 4, low, high, block)
    assert collections.Counter(tuple(r) for r in got.collect()) == mined(rows, 3, 4, low, high, lambda v: v is not None and v % 20 == 0)


def test_negatives_of_empty_tables(spark):
    rows = spark.createDataFrame([(100, 1, [1, 2]), (1, 2, [1, 2])], "vec_id int, label int, vector array<int>")
    anchor = F.col("vec_id") % 100 == 0
    none = kronecker_negatives.hard_negatives(rows.limit(0), anchor)
    assert none.count() == 0 and kronecker_negatives.hard_negatives(rows.filter("vec_id = 1"), anchor).count() == 0
    some = kronecker_negatives.hard_negatives(rows, anchor)  # an anchor without a positive
    assert some.count() == 0 and some.columns == none.columns
    huge = spark.createDataFrame([(100, 1, [1 << 40]), (1, 1, [1 << 40])], "vec_id int, label int, vector array<bigint>")
    with pytest.raises(ValueError, match="63 bits"):
        kronecker_negatives.hard_negatives(huge, anchor)
