"""URL filter cascade, exact dedup and line dedup."""

import hashlib
import random
import re
from collections import Counter

import pytest
from edge import documents, edge_docs, edge_rows
from pyspark.sql import functions as F

from encore.llm import bloom_dedup, url_cascade, winnow_lines
from encore.llm.common import cut, prepare

URLS = ["http://a.example.com/en/1", "https://www.example.com/en/", "https://x.www.EXAMPLE.com/en/2?q", "http://example.com",
        "http://example.com/", "http://b.net/es/3#f", "http://net/fr/", "http://notnet/fr/", "ftp://spam.org/x", None, "",
        "no scheme", "http://", "http:///es/", "http://spam.org", "http://b.net/en/x://y.com/", "http://B.NET/es/3",
        "http://" + "a." * 3000 + "net/es/" + "p" * 5000, "http://b.net/es/3#f"]
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[len(r.split("/")[0]):])]
    rule = max(fits, key=lambda r: (r.split("/")[0].count("."), len(r)), default=None)
    blocked = host == "spam.org" or host.endswith(".spam.org")
    return host, path, rule, RULES[rule] if rule else "block" if blocked else "allow"


def test_urls_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(URLS)], "page_id int, url string, row string, host string")
    got = url_cascade.judge_urls(pages, RULES, ["spam.org"]).select("row.page_id", "judged.*").collect()
    assert {r["page_id"]: tuple(r)[1:] for r in got} == {i: judge(u) for i, u in enumerate(URLS)}
    assert url_cascade.judge_urls(pages.limit(0), RULES, ["spam.org"]).count() == 0
    assert {r["verdict"] for r in url_cascade.judge_urls(pages, {}, []).select("judged.verdict").collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    prepare(spark)
    universe = cut(spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key")), "test-universe")
    listed = [f"k{i}" for i in range(0, 20_000, 37)] + ["elsewhere"]
    cascade = url_cascade.Cascade(universe, listed, "test")
    assert cascade.parts == 1 and len(cascade.levels[0]) > 2
    found = {r["key"] for r in universe.filter(cascade.contains(F.col("key"))).collect()}
    assert found == set(listed) - {"elsewhere"}


def test_cascade_above_the_bound_is_split(spark):
    universe = cut(prepare(spark).range(1000).select(F.col("id").cast("string").alias("key")), "test-universe")
    listed = [str(i) for i in range(0, 1000, 9)]
    cascade = url_cascade.Cascade(universe, listed, "test", max_bits=256)
    assert cascade.parts > 2 and all(bits <= 256 for levels in cascade.levels for _, bits, _, _ in levels)
    found = [r["key"] for part in range(cascade.parts) for r in universe.filter(cascade.contains(F.col("key"), part)).collect()]
    assert sorted(found) == sorted(listed)


def test_urls_against_brute_force_by_split_lists(spark):
    rng = random.Random(3)
    hosts = [f"{rng.choice('abc')}{rng.randrange(60)}.{rng.choice(['net', 'org'])}" for _ in range(150)]
    rules = {h + rng.choice(["", "/", "/en/"]): rng.choice(["allow", "block"]) for h in hosts}
    urls = [f"http://{rng.choice(['', 'x.', 'y.z.'])}{rng.choice('abc')}{rng.randrange(60)}.{rng.choice(['net', 'org'])}{rng.choice(['', '/', '/en/'])}" for _ in range(400)] + URLS
    blocked = ["spam.org", *{f"a{i}.net" for i in range(60)}]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    columns = ["row.page_id", "judged.*"]
    got = url_cascade.judge_urls(pages, rules, blocked, max_bits=200).select(*columns).collect()
    assert sorted(got) == sorted(url_cascade.judge_urls(pages, rules, blocked).select(*columns).collect())

    def fits(host, path, rule):
        h, slash, rest = rule.partition("/")
        return bool(host) and (host == h or host.endswith("." + h)) and path.startswith(slash + rest)

    for r in got:
        rule = max((x for x in rules if fits(r["host"], r["path"], x)), key=lambda x: (x.partition("/")[0].count("."), len(x.partition("/")[2]), "/" in x), default=None)
        verdict = rules[rule] if rule else "block" if any(fits(r["host"], r["path"], b) for b in blocked) else "allow"
        assert (r["rule"], r["verdict"]) == (rule, verdict), r


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("max_bits", [1 << 27, 64])
def test_exact_dedup_against_brute_force(spark, max_bits):
    rows = edge_rows()
    got = bloom_dedup.dedup_report(edge_docs(spark), max_bits=max_bits).collect()
    groups = {}
    for r in rows:
        groups.setdefault(lowered(r[1]), []).append(r[0])
    expected = Counter()
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for i in ids:
            expected[(i, best, len(ids), bool(i == best and left), sha)] += 1
            left -= i == best
    assert Counter(map(tuple, got)) == expected
    kept = bloom_dedup.dedup(edge_docs(spark), max_bits=max_bits).collect()
    assert sorted(lowered(r["text"]) for r in kept) == sorted(groups)
    assert bloom_dedup.dedup_report(edge_docs(spark, [])).count() == 0 == bloom_dedup.dedup(edge_docs(spark, [])).count()


def without_repeats(rows, run, words):
    """doc -> (non-blank lines, removed, text), by looking at every window."""
    seen, out = set(), {}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for r in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=key):
        lines = r[1].split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for at in range(len(solid)):
            for n in range(1, min(run, len(solid) - at) + 1):
                w = tuple(lines[i].strip(" ") for i in solid[at:at + n])
                if n < run and sum(len(re.split(" +", x)) for x in w) < words:
                    continue
                if w in seen:
                    gone |= set(solid[at:at + n])
                seen.add(w)
        out[r] = (len(solid), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


@pytest.mark.parametrize("run,words", [(1, 50), (2, 3), (3, 2), (3, 50), (4, 3)])
def test_line_dedup_against_brute_force(spark, run, words):
    rows = edge_rows() + [(900, "a\na\na\na\na", *[None] * 6), (901, "p\nb \n c\nd\na\nb", *[None] * 6),
                          (902, "a b\nc\n\nx  y z\nc\na b", *[None] * 6), (903, " x  y z\nc\nq\na b \nc\nx y z", *[None] * 6)]
    rows = [r for r in rows if r[:2] != (6, "another text with id six")]  # two texts of one id have no stated order here
    got = winnow_lines.dedup_lines(edge_docs(spark, rows), run, words).select("row.doc_id", F.col("row.text").alias("was"), "deduped.*").collect()
    expected = without_repeats(rows, run, words)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:] == (expected[(r["doc_id"], r["was"])] if r["was"] is not None else (0, 0, None))
    assert winnow_lines.dedup_lines(edge_docs(spark, []), run, words).count() == 0


def test_line_dedup_on_documents_with_a_saturated_filter(spark):
    rows = documents()
    got = winnow_lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), max_bits=64)
    expected = without_repeats(rows, winnow_lines.RUN, winnow_lines.WORDS)
    for r in got.select("row.doc_id", F.col("row.text").alias("was"), "deduped.*").collect():
        assert tuple(r)[2:] == expected[(r["doc_id"], r["was"])]


def test_long_passages_of_one_and_two_lines_go(spark):
    line = " ".join(f"w{i}" for i in range(51))
    first, second = line[:line.index(" w20")], line[line.index("w20"):]
    texts = [f"one\n{line}\ntwo", f"three\n\n{line} ", f"{first}\n{second}\nfour", f"five\n{first}\n\n{second}", f"{first}\nsix", line]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in winnow_lines.dedup_lines(docs).select("row.doc_id", "deduped.text").collect()}
    assert got == {0: texts[0], 1: "three\n", 2: texts[2], 3: "five\n", 4: texts[4], 5: ""}
