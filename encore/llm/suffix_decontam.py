"""Benchmark decontamination with suffix arrays of the training text.

The documents of a task are laid end to end in shards of a bounded number of
bytes. A shard's words become numbers, those that no benchmark item has being
all different, and its suffix array is built by prefix doubling: only groups
of suffixes that are still equal are sorted again. Every suffix of every
benchmark item is then found in it by binary search, for all suffixes at once.
The places where its first ``window`` words occur are the hits. For the longest
verbatim match every hit is compared with every place that its window has in
the benchmark, by one suffix array over the hits and those places together:
of all places, the next ones in its order share most words with a hit.

Documents never shuffle. The benchmark is sent to the tasks in blocks of about
``block_bytes`` of text, each made into arrays by itself; only a longer item
makes a larger block, as it stays whole for its longest matches. The documents
are passed over once for every ``blocks_a_pass`` blocks, a task taking one block
after the other, and are stored between two passes.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import annotate, cut, prepare, texts_of, words_of

WINDOW = 10
#: Bytes of benchmark text in a block, some 200,000 windows, and blocks in one pass over the documents.
BLOCK_BYTES, BLOCKS_A_PASS = 1 << 20, 8
#: Bytes of text in a shard. A longer document is a shard of its own.
SHARD_BYTES = 4 << 20

FOUND = ("n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>,"
         "longest:struct<words:bigint,start:bigint,item_id:string,item_start:bigint>")


def suffix_array(ids: np.ndarray, known: int) -> np.ndarray:
    """Positions of the words with ``0 < id <= known``, in the order of the suffixes that start there."""
    n = len(ids)
    at = np.flatnonzero((ids > 0) & (ids <= known))
    rank = np.arange(n + 1, dtype=np.int64) + n  # other words occur once: their order is settled
    if not at.size:
        return at
    sa = at[np.argsort(ids[at], kind="stable")]
    new = np.concatenate([[True], ids[sa][1:] != ids[sa][:-1]])
    rank[sa] = np.flatnonzero(new)[np.cumsum(new) - 1]
    slots = np.flatnonzero(~new | ~np.concatenate([new[1:], [True]]))
    h = 1
    while slots.size:
        pos = sa[slots]
        key = rank[pos] * (2 * n + 1) + rank[np.minimum(pos + h, n)]
        order = np.argsort(key, kind="stable")
        pos, key = pos[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        sa[slots] = pos
        rank[pos] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
        slots = slots[~new | ~np.concatenate([new[1:], [True]])]
        h *= 2
    return sa


class Benchmark:
    """The items of one block as numbers: ``ids`` of all words, items parted by 0, and their distinct windows."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.window, self.vocabulary, self.names = window, {}, []
        numbered, sizes = [np.zeros(1, np.int32)], []
        number = self.vocabulary.setdefault
        for name, text in items:
            if words := words_of(text):
                self.names.append(name)
                sizes.append(len(words))
                item = np.zeros(len(words) + 1, np.int32)
                item[:-1] = [number(w, len(self.vocabulary) + 1) for w in words]
                numbered.append(item)
        self.ids = np.concatenate([*numbered, np.zeros(window, np.int32)])
        del numbered
        # Every place of a window, the item that it is in and its word there.
        size = np.array(sizes, np.int64)
        start_at, name_at = _ranges(np.zeros(len(size), np.int64), np.maximum(size - window, 0) + 1)
        place = (np.cumsum(size + 1) - size)[name_at] + start_at
        length = np.minimum(size, window)[name_at]
        rows = np.where(np.arange(window) < length[:, None], self.ids[place[:, None] + np.arange(window)], 0)
        _, first, of = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        del rows
        of = of.reshape(-1)
        self.starts, self.lengths = place[first], length[first]
        # Items by window, and the places of every window, window by window, with each place's rank by item id and then
        # by its word in the item.
        owned = np.unique(of * max(len(size), 1) + name_at)
        self.owners = owned % max(len(size), 1)
        self.owner_at = np.searchsorted(owned // max(len(size), 1), np.arange(len(first) + 1))
        by_window = np.argsort(of, kind="stable")
        self.places = place[by_window]
        self.place_at = np.searchsorted(of[by_window], np.arange(len(first) + 1))
        new = np.array([i == 0 or self.names[i] != self.names[i - 1] for i in range(len(self.names))], bool)
        by_rank = np.lexsort((start_at, np.cumsum(new)[name_at]))
        rank = np.empty(len(of), np.int64)
        rank[by_rank] = np.arange(len(of))
        self.place_rank = rank[by_window]
        self.name_of_rank, self.start_of_rank = name_at[by_rank], start_at[by_rank]

    def search(self, ids: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window the range of the suffix array that starts with it."""
        padded = np.concatenate([ids, np.full(self.window, np.iinfo(np.int64).max)])
        columns = np.arange(self.window)
        # The words of every window, in columns; where it is shorter, nothing is compared.
        heads, inside = self.ids[self.starts[:, None] + columns], columns < self.lengths[:, None]

        def bound(upper: bool) -> np.ndarray:
            lo, hi = np.zeros(len(self.starts), np.int64), np.full(len(self.starts), len(sa), np.int64)
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) // 2
                own, asked = padded[sa[mid][:, None] + columns], heads[open_]
                differ = (own != asked) & inside[open_]
                first = differ.argmax(axis=1)
                row = np.arange(len(open_))
                less = differ[row, first] & (own[row, first] < asked[row, first])
                below = less | ~differ.any(axis=1) if upper else less
                lo[open_] = np.where(below, mid + 1, lo[open_])
                hi[open_] = np.where(below, hi[open_], mid)
            return lo

        return bound(False), bound(True)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), and which range each is of."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[which], which


def longest_matches(pos: np.ndarray, window: np.ndarray, doc: np.ndarray, bench: Benchmark) -> dict[int, tuple[int, int, int]]:
    """For each document its longest match of whole windows: (words, its position, rank of the benchmark place).

    ``pos`` are the positions at which a whole ``window`` occurs. Of matches of
    one length the first in the document counts, and of its places the one of
    the smallest rank. Two places share ``l`` windows in a row if they share
    ``l + bench.window - 1`` words, so windows are compared instead of words.
    """
    if not pos.size:
        return {}
    order = np.argsort(pos)
    pos, window, doc = pos[order], window[order], doc[order]
    hit = np.unique(window)
    slot, which = _ranges(bench.place_at[hit], bench.place_at[hit + 1])
    slot, which = slot[(order := np.argsort(bench.places[slot]))], which[order]
    # Nodes: first the hits, then the places, each in the order of the text.
    n_hits = len(pos)
    at = np.concatenate([pos, bench.places[slot] + pos[-1] + 2])
    symbol = np.concatenate([np.searchsorted(hit, window), which])
    m = len(at)
    at_ = np.concatenate([at, [-1]])

    def later(node: np.ndarray, h: int) -> np.ndarray:
        """The node ``h`` windows on, or m where the run of nodes ends before it. Each run ends in a symbol of its own."""
        to = np.minimum(node + h, m)
        return np.where(at_[to] == at_[node] + h, to, m)

    # Prefix doubling; levels[k] numbers the nodes by their first 2^k windows.
    sa = np.argsort(symbol, kind="stable")
    new = np.concatenate([[True], symbol[sa][1:] != symbol[sa][:-1]])
    rank = np.empty(m, np.int64)
    rank[sa] = np.flatnonzero(new)[np.cumsum(new) - 1]
    slots = np.flatnonzero(~new | ~np.concatenate([new[1:], [True]]))
    levels, h = [rank.copy()], 1
    while slots.size:
        nodes = sa[slots]
        to = later(nodes, h)
        key = rank[nodes] * (3 * m) + np.where(to < m, rank[np.minimum(to, m - 1)], m + nodes + h)
        order = np.argsort(key, kind="stable")
        nodes, key = nodes[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        sa[slots] = nodes
        rank[nodes] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
        slots = slots[~new | ~np.concatenate([new[1:], [True]])]
        h *= 2
        levels.append(rank.copy())

    def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Windows that the nodes of a and b have in common from their start on."""
        n = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels))):
            open_ = np.flatnonzero((a < m) & (b < m))
            same = open_[levels[k][a[open_]] == levels[k][b[open_]]]
            n[same] += 1 << k
            a, b = a.copy(), b.copy()
            a[same], b[same] = later(a[same], 1 << k), later(b[same], 1 << k)
        return n

    in_order = np.flatnonzero(sa >= n_hits)
    places = sa[in_order]
    before = np.searchsorted(in_order, rank[:n_hits])  # places ahead of each hit in the order
    hits = np.arange(n_hits)
    n = np.zeros(n_hits, np.int64)
    for near in (before - 1, before):
        ok = np.flatnonzero((near >= 0) & (near < len(places)))
        n[ok] = np.maximum(n[ok], shared(hits[ok], places[near[ok]]))
    first = np.lexsort((pos, -n, doc))
    best = first[np.unique(doc[first], return_index=True)[1]]
    # The places that share as much lie around the hit in the order.
    lo, hi = np.zeros(len(best), np.int64), before[best].copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        enough = shared(best[open_], places[mid]) >= n[best[open_]]
        hi[open_], lo[open_] = np.where(enough, mid, hi[open_]), np.where(enough, lo[open_], mid + 1)
    left = lo
    lo, hi = before[best].copy(), np.full(len(best), len(places), np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        enough = shared(best[open_], places[mid]) >= n[best[open_]]
        lo[open_], hi[open_] = np.where(enough, mid + 1, lo[open_]), np.where(enough, hi[open_], mid)
    right = lo
    # Smallest rank of each range [left, right): two overlapping stretches of a power of two.
    least, chosen = bench.place_rank[slot][places - n_hits], np.zeros(len(best), np.int64)
    power = np.frexp(right - left)[1] - 1
    for k in range(int(power.max()) + 1):
        if k:
            least = np.minimum(least[:-(1 << (k - 1))], least[1 << (k - 1):])
        ask = np.flatnonzero(power == k)
        chosen[ask] = np.minimum(least[left[ask]], least[right[ask] - (1 << k)])
    return {int(d): (int(w) + bench.window - 1, int(p), int(r)) for d, w, p, r in zip(doc[best], n[best], pos[best], chosen)}


def search_shard(texts: list[bytes | None], bench: Benchmark) -> list[dict]:
    """The result of every document of a shard."""
    per_doc = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in per_doc], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1  # a word of no item stands between two documents
    total, known = int((sizes + 1).sum()), len(bench.vocabulary)
    ids = np.zeros(total, np.int64)
    find = bench.vocabulary.get
    for words, at in zip(per_doc, begin):
        if words:
            ids[at:at + len(words)] = np.fromiter(map(find, words, repeat(0)), np.int64, len(words))
    del per_doc
    other = ids == 0
    ids[other] = np.flatnonzero(other) + known + 1
    sa = suffix_array(ids, known)
    lo, hi = bench.search(ids, sa)
    slot, window = _ranges(lo, hi)
    pos = sa[slot]
    doc = np.searchsorted(begin, pos, side="right") - 1
    # Words inside any occurrence, as the intervals that the occurrences cover.
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, pos, 1)
    np.add.at(cover, pos + bench.lengths[window], -1)
    inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    span_doc = np.searchsorted(begin, starts, side="right") - 1
    # Items by document, from the distinct (document, window).
    pairs = np.unique(doc * (len(bench.starts) + 1) + window)
    pair_doc, pair_window = pairs // (len(bench.starts) + 1), pairs % (len(bench.starts) + 1)
    at, which = _ranges(bench.owner_at[pair_window], bench.owner_at[pair_window + 1])
    owned = np.unique(pair_doc[which] * (len(bench.names) + 1) + bench.owners[at])
    owned_doc, owned_item = owned // (len(bench.names) + 1), owned % (len(bench.names) + 1)
    # The longest match: of whole windows by all their places, else of the items that are shorter.
    whole = np.flatnonzero(bench.lengths[window] == bench.window)
    best = longest_matches(pos[whole], window[whole], doc[whole], bench)
    short = np.flatnonzero(bench.lengths[window] < bench.window)
    short = short[np.lexsort((pos[short], -bench.lengths[window[short]], doc[short]))]
    for k in short[np.unique(doc[short], return_index=True)[1]].tolist():
        w = window[k]
        first = bench.place_rank[bench.place_at[w]:bench.place_at[w + 1]].min()
        best.setdefault(int(doc[k]), (int(bench.lengths[w]), int(pos[k]), int(first)))
    longest = {d: {"words": n, "start": p - int(begin[d]), "item_id": bench.names[bench.name_of_rank[r]],
                   "item_start": int(bench.start_of_rank[r])} for d, (n, p, r) in best.items()}
    out = [{"n_words": int(n), "spans": [], "items": [], "longest": longest.get(d)} for d, n in enumerate(sizes)]
    for d, s, e in zip(span_doc.tolist(), starts.tolist(), ends.tolist()):
        out[d]["spans"].append({"start": s - int(begin[d]), "end": e - int(begin[d])})
    for d, i in zip(owned_doc.tolist(), owned_item.tolist()):
        out[d]["items"].append(bench.names[i])
    return out


def shards(texts: list[bytes | None], limit: int):
    """Consecutive texts of up to ``limit`` bytes together, at least one."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t or b"") > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or b"")
    if part:
        yield part


def merged(a: dict, b: dict) -> dict:
    """One document's results over two blocks of the benchmark."""
    spans: list[dict] = []
    for s in sorted(a["spans"] + b["spans"], key=lambda s: (s["start"], s["end"])):
        if spans and s["start"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], s["end"])
        else:
            spans.append(dict(s))
    longest = min((x["longest"] for x in (a, b) if x["longest"]),
                  key=lambda x: (-x["words"], x["start"], x["item_id"], x["item_start"]), default=None)
    return {"n_words": a["n_words"], "spans": spans, "items": sorted({*a["items"], *b["items"]}), "longest": longest}


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, blocks_a_pass: int = BLOCKS_A_PASS) -> DataFrame:
    """Every row of ``docs`` with what it shares with the benchmark, in a struct ``found`` beside ``row``.

    ``benchmark`` has ``item_id`` and ``text``. ``found`` holds ``n_words``,
    ``spans`` (word intervals covered by occurrences of a window, joined),
    ``items`` (ids, as strings, of the items that have an occurring window)
    and ``longest`` (words of the longest verbatim match that has a whole
    window, its place in the document, and the item and place it is of; of
    several the first in the document, then the smallest item id as a string,
    then the first place in it).

    A window is ``window`` consecutive words of an item; an item of fewer
    words, but not none, is one window. Null and empty texts have no words and
    no hits; null item ids count as the id ``null``; items with equal windows
    are all named; an empty table or benchmark gives no hits. Repeated rows
    are judged each by itself, and other columns stay in ``row``.
    """
    spark = prepare(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = benchmark.agg(F.sum(size).alias("n")).first()["n"] or 0
    blocks = int(total // max(1, block_bytes)) + 1
    of_block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for done in range(0, blocks, blocks_a_pass):
        sent = []
        for block in range(done, min(done + blocks_a_pass, blocks)):
            items = benchmark.filter(of_block == block).select(
                F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), F.col("text").cast("binary").alias("t"))
            sent.append(spark.sparkContext.broadcast(
                Benchmark(sorted((r["i"], bytes(r["t"] or b"")) for r in items.collect()), window)))
        found = annotate(docs if out is None else out, text if out is None else F.col("row").getField(text),
                         _searcher(sent), f"found struct<{FOUND}>")
        out = found if out is None else _merge(found.select("row.*", F.col("found").alias("next")))
        if blocks > blocks_a_pass:
            out = cut(out, f"contamination-{done}")
    return out


def _searcher(sent: list):
    schema = _found_type()

    def search(batches):
        for b in batches:
            out = []
            for part in shards(texts_of(b, "text"), SHARD_BYTES):
                found = search_shard(part, sent[0].value)
                for block in sent[1:]:
                    found = [merged(x, y) for x, y in zip(found, search_shard(part, block.value))]
                out += found
            yield pa.RecordBatch.from_arrays([pa.array(out, schema)], names=["found"])

    return search


def _found_type() -> pa.DataType:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    longest = pa.struct([("words", pa.int64()), ("start", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())])
    return pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string())),
                      ("longest", longest)])


def _merge(both: DataFrame) -> DataFrame:
    """Join the results ``found`` and ``next`` of the same rows."""
    schema = _found_type()

    def run(batches):
        for b in batches:
            done = [merged(x, y) for x, y in zip(b.column("found").to_pylist(), b.column("next").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(done, schema)], names=["row", "found"])

    out = both.select("row", "found")
    return both.select("row", "found", "next").mapInArrow(run, out.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, whole and with their own columns."""
    found = find_contamination(docs, benchmark, window=window)
    return found.filter(F.size("found.spans") == 0).select("row.*")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id`` with the counts and the digest of the items, from ``find_contamination``."""
    n_hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    items = F.sort_array("found.items")
    return found.select(
        "row.doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"), F.col("found.longest.words").alias("longest_words"),
        F.col("found.longest.start").alias("longest_start"), F.col("found.longest.item_id").alias("longest_item"))
