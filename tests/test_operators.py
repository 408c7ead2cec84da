"""Operator properties: the skew-safe forms equal the plain forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rows import at
from encore.operators.enrich import enrich_asof, enrich_latest
from encore.operators.keyed import arg_max_first, latest_by_key
from encore.operators.route import route, split
from encore.operators.running import Spec, carried_totals, hot_keys, in_cells, prefix_scan
from encore.operators.sketch import combined_counters, counters, frequent, slots
from encore.operators.tables import outer_changelog, withdrawn_sum
from encore.operators.topk import top_k_per_group
from encore.streaming.carried import whole_table


def _rows(spark, n=300, keys=4, seed=7, hot=True):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = "hot" if hot and rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
        v = rnd.choice([None, rnd.randint(-50, 100)])
        data.append((k, at(i, 0.7), i, v))
    return spark.createDataFrame(data, "k string, t timestamp, i int, v int")


def plain(df, keys, order, specs):
    """Running values by one window per key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    fns = {"count": lambda v: F.count(v if v is not None else F.lit(1)), "sum": F.sum, "max": F.max, "min": F.min,
           "last": lambda v: F.last(v, ignorenulls=True)}
    return df.select("*", *[fns[s.op](s.column()).over(before if s.before else w).alias(s.out) for s in specs])


@pytest.mark.parametrize("keys", [["k"], []])
def test_prefix_scan_equals_window(spark, keys):
    df = _rows(spark)
    specs = [Spec("c", "count"), Spec("s", "sum", "v"), Spec("mx", "max", "v"), Spec("mn", "min", "v"),
             Spec("lst", "last", "v"), Spec("cv", "count", "v"), Spec("c0", "count", before=True),
             Spec("s0", "sum", "v", before=True), Spec("mx0", "max", "v", before=True), Spec("lst0", "last", "v", before=True)]
    order = [F.col("t"), F.col("i")]
    want = plain(df, keys, order, specs).orderBy("i").collect()
    for seconds in (5, 60, 100_000):
        assert prefix_scan(df, keys, order, "t", specs, cell=seconds * 1_000_000).orderBy("i").collect() == want


@pytest.mark.parametrize("rows, most", [(0, 1 << 16), (20, 1 << 16), (20, 1), (1 << 40, 1)])
def test_cells_for_hot_keys_alone(spark, rows, most):
    """Whatever keys have cells, the running values are the same; a key outside the hot ones is one cell."""
    df = _rows(spark, n=400, keys=30)
    specs = [Spec("c", "count"), Spec("s", "sum", "v"), Spec("mx", "max", "v"), Spec("lst", "last", "v"), Spec("c0", "count", before=True)]
    order = [F.col("t"), F.col("i")]
    hot = hot_keys(df, ["k"], rows, most)
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    named = {r["k"] for r in hot.collect()}
    assert len(named) == min(most, sum(n > rows for n in counts.values()))
    assert all(n <= max(rows, min((counts[k] for k in named), default=0)) for k, n in counts.items() if k not in named)
    got = prefix_scan(df, ["k"], order, "t", specs, cell=9_000_000, hot=hot).orderBy("i").collect()
    assert got == plain(df, ["k"], order, specs).orderBy("i").collect()
    cells = {r["k"]: r["n"] for r in in_cells(df, ["k"], "t", 9_000_000, hot).groupBy("k").agg(
        F.countDistinct("__cell").alias("n")).collect()}
    assert all(cells[k] == 1 for k in counts if k not in named) and ("hot" not in named or cells["hot"] > 5)


@pytest.mark.parametrize("block", [1, 3, 1 << 12])
def test_totals_are_carried_over_blocks_of_cells(spark, block):
    rnd = random.Random(17)
    cells = sorted(rnd.sample(range(-20, 60), 40))
    rows = [(c, rnd.randrange(5), rnd.choice([None, rnd.randrange(-9, 9)]), rnd.choice([None, rnd.randrange(9)]),
             rnd.choice([None, f"x{c}"])) for c in cells]
    totals = spark.createDataFrame(rows, "__cell bigint, __t_n bigint, __t_s bigint, __t_m bigint, __t_l string")
    specs = [Spec("n", "count"), Spec("s", "sum", "v"), Spec("m", "max", "v"), Spec("l", "last", "v")]
    got = carried_totals(totals, [], specs, block).orderBy("__cell").collect()

    def over(values, of):
        there = [v for v in values if v is not None]
        return of(there) if there else None

    for i, r in enumerate(got):
        n, s, m, l = ([row[j] for row in rows[:i]] for j in range(1, 5))
        assert tuple(r) == (cells[i], over(n, sum), over(s, sum), over(m, max), over(l, lambda x: x[-1]))
    assert len(got) == len(rows) and carried_totals(totals.limit(0), [], specs, block).count() == 0


def test_prefix_scan_drops_null_keys_and_takes_empty_input(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, pos bigint")
    rows = prefix_scan(df, ["k"], [F.col("pos")], "pos", [Spec("n", "count")], cell=1).collect()
    assert sorted((r["pos"], r["n"]) for r in rows) == [(1, 1), (3, 2)]
    assert prefix_scan(df.limit(0), ["k"], [F.col("pos")], "pos", [Spec("n", "count")]).count() == 0


def test_top_k_salted_equals_plain(spark):
    df = _rows(spark, n=500)
    order = [F.desc("v"), F.col("i")]
    a = top_k_per_group(df.where("v is not null"), "k", order, 5).orderBy("k", "rank").collect()
    b = top_k_per_group(df.where("v is not null"), "k", order, 5, salt_buckets=7, salt=F.col("i")).orderBy(
        "k", "rank").collect()
    assert a == b


def test_arg_max_first(spark):
    df = spark.createDataFrame([("g", 5, 3, "late"), ("g", 5, 1, "early"), ("g", 2, 0, "small"), ("h", 1, 0, "x")],
                               "g string, v int, pos int, who string")
    out = {r["g"]: (r["v"], r["who"]) for r in arg_max_first(df, "g", "v", [F.col("pos")], ["who"]).collect()}
    assert out == {"g": (5, "early"), "h": (1, "x")}


def test_latest_by_key_with_tombstone(spark):
    df = spark.createDataFrame([("a", 1, "v1", False), ("a", 2, "v2", False), ("b", 1, "x", False),
                                ("b", 2, None, True), (None, 3, "n", False)],
                               "k string, pos int, val string, dead boolean")
    out = latest_by_key(df, "k", [F.col("pos")], tombstone=F.col("dead"))
    assert [(r["k"], r["val"]) for r in out.collect()] == [("a", "v2")]


def test_enrich_asof_and_latest(spark):
    table = spark.createDataFrame([("e1", 5, at(0)), ("e1", 9, at(10)), ("e2", 3, at(20))],
                                  "id string, capacity int, t timestamp")
    stream = spark.createDataFrame([("t1", "e1", at(5)), ("t2", "e1", at(15)), ("t3", "e2", at(15)),
                                    ("t4", "e2", at(25))], "tid string, eventid string, arrival timestamp")
    kw = dict(stream_key="eventid", table_key="id", stream_time="arrival", table_time="t",
              stream_tie=["tid"], table_tie=["id"], table_cols=["capacity"])
    asof = {r["tid"]: r["capacity"] for r in enrich_asof(stream, table, **kw).collect()}
    assert asof == {"t1": 5, "t2": 9, "t4": 3}     # t3 arrives before its event: dropped
    small = {r["tid"]: r["capacity"] for r in enrich_asof(stream, table, cell=7_000_000, **kw).collect()}
    assert small == asof
    latest = {r["tid"]: r["capacity"] for r in enrich_latest(stream, table, "eventid", "id", ["capacity"],
                                                               table_order=[F.col("t")]).collect()}
    assert latest == {"t1": 9, "t2": 9, "t3": 3, "t4": 3}


def test_route_first_match_and_drop(spark):
    df = spark.createDataFrame([(1,), (5,), (10,)], "x int")
    r = route(df, [("small", F.col("x") < 6), ("tiny", F.col("x") < 2)])
    assert sorted((x["x"], x["route"]) for x in r.collect()) == [(1, "small"), (5, "small")]
    parts = split(df, [("big", F.col("x") > 6)], default="rest")
    assert sorted(x["x"] for x in parts["rest"].collect()) == [1, 5]
    assert [x["x"] for x in parts["big"].collect()] == [10]


@pytest.mark.parametrize("cell", [3, 1 << 12])
def test_outer_changelog_withdraws_what_an_update_replaces(spark, cell):
    rnd = random.Random(11)
    data = [(i, rnd.choice(["hot", "hot", "a", "b", None]), rnd.randrange(2), rnd.choice([None, 1, 2, 3])) for i in range(400)]
    records = spark.createDataFrame(data, "pos bigint, k string, side int, v int")
    order, scan = [F.col("pos")], whole_table(cell)
    joined = outer_changelog(records, "k", order, "pos", "side", "v", scan)
    tables, want, total = ({}, {}), [], {}
    for pos, k, side, v in data:
        if k is None:
            continue
        old = (tables[0].get(k), tables[1].get(k))
        tables[side][k] = v
        new = (tables[0].get(k), tables[1].get(k))
        if old != (None, None) or new != (None, None):
            before = total.get("all")
            product = lambda row: row[0] * row[1] if None not in row else 0
            total["all"] = (before or 0) + product(new) - product(old)
            want.append((pos, k, side, old, new, before, total["all"]))
    products = {s: F.col(f"{s}.left") * F.col(f"{s}.right") for s in ("old", "new")}
    got = withdrawn_sum(joined, [], order, "pos", products["old"], products["new"], scan).orderBy("pos").collect()
    assert [(r["pos"], r["k"], r["side"], tuple(r["old"]), tuple(r["new"]), r["old_n"], r["new_n"]) for r in got] == want
    assert any(w[6] < w[5] for w in want[1:])  # sums go down as well
    assert outer_changelog(records.limit(0), "k", order, "pos", "side", "v", scan).count() == 0


def test_bounded_counters_keep_their_bounds(spark):
    rnd = random.Random(13)
    # Every customer has many more items than a sketch holds, a few of them frequent; item ids repeat over batches.
    rows = [(c, b, int(rnd.paretovariate(0.7)) % 5000) for c in range(6) for b in range(3) for _ in range(4000)]
    rows += [(9, 0, i % 7) for i in range(50)] + [(10, 0, None), (None, 0, 1)]
    df = spark.createDataFrame(rows, "c int, b int, item int").repartition(5)
    exact = {}
    for c, _, item in rows:
        if item is not None:
            exact.setdefault(c, {}).setdefault(item, 0)
            exact[c][item] += 1
    tracked = 96
    assert slots(tracked) == 128 and slots(1024) == 2048 and slots(97) == 256
    whole = counters(df, ["c"], "item", tracked)
    parts = combined_counters(counters(df, ["c", "b"], "item", tracked), ["c"])
    for sketches in (whole, parts):
        found = {}
        for r in frequent(sketches, ["c"], "item", tracked, tracked).collect():
            found.setdefault(r["c"], {})[r["item"]] = r["n"]
            assert r["error"] == int(3.5 * sum(exact[r["c"]].values()) / 128)
            assert exact[r["c"]].get(r["item"], 0) <= r["n"] <= exact[r["c"]].get(r["item"], 0) + r["error"]
        assert found.keys() == exact.keys()
        for c, items in exact.items():
            error = int(3.5 * sum(items.values()) / 128)
            assert all(i in found[c] for i, n in items.items() if n > 2 * error)
            assert len(items) > tracked or found[c] == items
    assert any(len(items) > 4 * tracked for items in exact.values())
