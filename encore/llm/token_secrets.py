"""Secret scans: fixed patterns, and the token efficiency of what looks random.

A byte-pair vocabulary gives frequent letter sequences tokens of their own, so
ordinary words take many characters per token and random strings about two.
Long strings, with what single dots join to them, are encoded, and those with
few characters per token are reported, unless they are a known kind of digest,
address or identifier: hexadecimal digests, UUIDs, numbers, dates, hosts and
paths of urls, e-mail addresses, names made of words (camelCase, snake_case,
kebab-case). Values in the query of a url and what stands before the @ of its
host are looked at like other strings.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import annotate, prepare

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run: the same spans as [0-9a-f]+ without the short ones
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16

#: Shortest string that is encoded, and the characters per token at which one counts as random.
LEAST_LENGTH, MOST_RATIO = 20, 2.4
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DOTTED = re.compile(r"(?:\.[A-Za-z0-9+/_=-]+)*")
CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
DIGESTS = (32, 40, 48, 56, 64, 96, 128)  # hexadecimal digits of MD5, SHA-1, Tiger, SHA-224, -256, -384, -512
IS_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
URL_HOST = re.compile(r"""[^\s"'<>/?#]*""")
URL_PATH = re.compile(r"""[^\s"'<>?#]*""")
HOST = re.compile(r"(?:[a-z0-9-]{1,63}\.)+[a-z]{2,18}(?=/|\Z)")
MAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]")
MAIL_HOST = re.compile(r"@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,18}(?![A-Za-z0-9])")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def covered(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that sorted spans cover, both ascending."""
    starts: list[int] = []
    ends: list[int] = []
    for s, _, e in spans:
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def known(string: str, efficiency: TokenEfficiency, most_ratio: float) -> bool:
    """Whether a string is a digest or an identifier."""
    if not any(c.isalpha() for c in string):
        return True
    if len(string) in DIGESTS and IS_HEX.fullmatch(string) or UUID.fullmatch(string):
        return True
    words = [p for p in PIECE.findall(string) if p[0].isalpha()]
    letters = sum(map(len, words))
    # Names made of words: long pieces that the vocabulary takes for words.
    return bool(words) and letters / len(words) >= 4 and letters > most_ratio * sum(map(efficiency.tokens, words))


def url_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the hosts and paths of all urls with a scheme, ascending; a user before the host is left out."""
    out = []
    at = text.find("://")
    while at >= 0:
        sign = text.rfind("@", at + 3, URL_HOST.match(text, at + 3).end())
        end = URL_PATH.match(text, at + 3).end()
        out.append((sign + 1 if sign >= 0 else at, end))
        at = text.find("://", end)
    return out


def in_address(text: str, start: int, end: int, urls: list[tuple[int, int]]) -> bool:
    """Whether a string is of a url's host or path, of an e-mail address, or a host without a scheme."""
    near = bisect_right(urls, (start, len(text))) - 1
    if near >= 0 and start < urls[near][1] or HOST.match(text, start, end):
        return True
    if text[end:end + 1] == "@" and MAIL_HOST.match(text, end):
        return not any(s == end + 1 for s, _ in urls[near + 1:near + 2])  # else a key before the host of a url
    return start > 1 and bool(MAIL_NAME.match(text, start - 2) and MAIL_HOST.match(text, start - 1))


def joined(text: str, start: int, end: int, least: int) -> tuple[int, int]:
    """A candidate with all that single dots join to it, from ``least`` on."""
    while start - 1 > least and text[start - 1] == ".":
        at = start - 1
        while at > least and text[at - 1] in CHARACTERS:
            at -= 1
        if at == start - 1:
            break
        start = at
    return start, DOTTED.match(text, end).end()


class TokenEfficiency:
    """Characters per token under a vocabulary of ranked tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def tokens(self, string: str) -> int:
        return len(self.encoding.encode_ordinary(string))

    def ratio(self, string: str) -> float:
        return len(string) / max(1, self.tokens(string))


def spans_of(text: str, efficiency: TokenEfficiency, most_ratio: float = MOST_RATIO) -> list[tuple[int, int, int]]:
    """Base spans and those that the token efficiency adds, where no base span is, by start and kind."""
    base = base_spans(text)
    more: list[tuple[int, int, int]] = []
    urls, done = None, 0
    starts, ends = covered(base)

    def free(a: int, b: int) -> bool:
        near = bisect_left(starts, b) - 1  # the last stretch that begins before the end
        return near < 0 or ends[near] <= a

    def random(a: int, b: int) -> bool:
        return not known(text[a:b], efficiency, most_ratio) and efficiency.ratio(text[a:b]) <= most_ratio

    for m in CANDIDATE.finditer(text):
        if m.start() < done:
            continue  # in the dotted string of an earlier one
        a, b = joined(text, m.start(), m.end(), done)
        done = b
        if text[max(0, a - 1):a + 2] == "://":
            a += 2
        urls = url_spans(text) if urls is None else urls
        if in_address(text, a, b, urls):
            continue
        parts = [p.span() for p in CANDIDATE.finditer(text, a, b)]
        parts = [p for p in parts if random(*p)]
        if parts and free(a, b) and efficiency.ratio(text[a:b]) <= most_ratio:
            more.append((a, 3, b))
        else:
            more += [(s, 3, e) for s, e in parts if free(s, e)]
    return sorted(base + more)


def find_secrets(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text",
                 most_ratio: float = MOST_RATIO) -> DataFrame:
    """Every row of ``docs`` with a column ``spans`` beside ``row``: ``kind``, ``start`` and ``end`` (code points,
    end exclusive) of all secrets, by start and then kind.

    ``vocabulary`` is the file of a tiktoken vocabulary that every worker has,
    ``pattern`` what splits text before its merges. Null and empty texts have
    no spans, repeated rows are scanned each by itself, an empty table gives
    an empty result, other columns stay in ``row``.
    """
    prepare(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        efficiency = TokenEfficiency(vocabulary, pattern)
        for b in batches:
            out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t, efficiency, most_ratio)] if t else []
                   for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(span))], names=["spans"])

    return annotate(docs, text, run, "spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id``, the counts of the base kinds and the spans as text, from ``find_secrets``."""
    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("row.doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"),
                        count("random"))
