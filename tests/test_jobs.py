"""The jobs against their definitions, on random rows with ties, hot keys, unknown keys and nulls.

Every expected value is recomputed from all records up to a position, never
carried along. ``cell`` is small, so that every running value crosses cells.
"""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rows import at
from encore.plans import jobs as J
from encore.plans import scenarios as R
from encore.streaming.carried import whole_table

SECOND = 1_000_000
SEEDS = [1, 2]


def names(prefix, n):
    return [f"{prefix}{i}" for i in range(n)]


def sale(spark, seed, n=90):
    """(tickets, events): some events unknown, some without an artist, several tickets in one second."""
    rng = random.Random(seed)
    events = [(f"show{i}", None if i == 4 else f"act{i % 3}", f"hall{i % 2}", [2, 9, 30, 5, 4][i], "2031-02-03") for i in range(5)]
    tickets = [(f"#{i:03d}", rng.choice(names("fan", 6) + [None]), rng.choice(["show0"] * 3 + names("show", 7)),
                rng.choice([-12.5, 0.0, 3.99, 8.0, 8.0, 41.75]), at(i // 3)) for i in range(n)]
    return (spark.createDataFrame(tickets, "id string, customerid string, eventid string, price double, arrival timestamp"),
            spark.createDataFrame(events, "id string, artistid string, venueid string, capacity int, eventdate string"),
            tickets, {e[0]: e for e in events})


def joined(tickets, events):
    return tickets.join(events.select(F.col("id").alias("eventid"), "artistid", "venueid", "capacity", "eventdate"), "eventid")


# ---------------------------------------------------------------- P1

def best_three(records):
    """records: artists in the order of the listens. The top three: by count, then who got there first."""
    last = {a: i for i, a in enumerate(records)}
    return sorted(Counter(records).items(), key=lambda x: (-x[1], last[x[0]]))[:3]


@pytest.mark.parametrize("seed", SEEDS)
def test_top_artists_and_their_changelog(spark, listens, seed):
    rng = random.Random(seed)
    pairs = [(rng.choice("ppppqr"), rng.choice(names("act", 5) + [None])) for _ in range(80)]
    df = listens(pairs)
    got = {r["pos"]: r for r in J.top_customer_artists_changelog_from(df, scan=whole_table(16)).collect()}
    for i, (who, _) in enumerate(pairs):
        assert [tuple(x) for x in got[i]["top"]] == best_three([a for c, a in pairs[:i + 1] if c == who])
    last = {}
    for r in J.top_customer_artists_from(df, salt_buckets=3).orderBy("rank").collect():
        last.setdefault(r["customerid"], []).append((r["artistid"], r["n"]))
    assert last == {c: best_three([a for x, a in pairs if x == c]) for c in "pqr"}


def test_a_favourite_found_after_a_thousand_artists(listens):
    pairs = [("p", f"act{i}") for i in range(1200)] + [("p", "late")] * 2
    top = J.top_customer_artists_from(listens(pairs)).orderBy("rank").collect()
    assert [(r["artistid"], r["n"]) for r in top] == [("late", 2), ("act0", 1), ("act1", 1)]


def test_nested_top(listens):
    flat = J.top_customer_artists_from(listens([("p", "y"), ("p", "y"), ("p", "x")]))
    assert [tuple(x) for x in J.top_customer_artists_nested(flat).first()["top"]] == [("y", 2), ("x", 1)]


# ---------------------------------------------------------------- P2

def answers(requests):
    """requests: (ticket, event, capacity seen or None) in arrival order."""
    out = {}
    for i, (ticket, event, capacity) in enumerate(requests):
        if capacity is None:
            continue
        mine = [c for _, e, c in requests[:i + 1] if e == event and c is not None]
        left = mine[0] - len(mine)
        share = 100 * left / mine[0] if mine[0] else None
        out[ticket] = (float(left), "REJECTED" if left < 0 else "CONFIRMED",
                       "NONE" if left < 0 else "SOLD_OUT_NOW" if left == 0 else "LIMITED" if share <= 20 else "AVAILABLE")
    return out


@pytest.mark.parametrize("seed", SEEDS)
def test_confirmations(spark, seed):
    t, e, tickets, events = sale(spark, seed)
    out = J.confirm_tickets(joined(t, e), whole_table(4 * SECOND)).collect()
    want = answers([(x[0], x[2], events[x[2]][3] if x[2] in events else None) for x in tickets])
    assert {r["ticket_id"]: (r["remainingTickets"], r["confirmationStatus"], r["availability"]) for r in out} == want
    assert len({r["confirmationId"] for r in out}) == len(want)


def test_confirmations_over_a_changing_event_table(spark):
    """No event yet, then 2 seats, raised to 5 (too late to matter), deleted, and back with 9 (too late as well)."""
    changes = [("gig", 2, at(10)), ("gig", 5, at(20)), ("gig", None, at(30)), ("gig", 9, at(40)), ("other", None, at(0))]
    events = spark.createDataFrame(changes, "id string, capacity int, updated timestamp")
    arrivals = [1, 10, 11, 12, 21, 31, 32, 41]
    t = spark.createDataFrame([(f"#{s:02d}", "fan", "gig", 1.0, at(s)) for s in arrivals] + [("#99", "fan", "other", 1.0, at(50))],
                              "id string, customerid string, eventid string, price double, arrival timestamp")
    for cell in (3 * SECOND, None):
        out = J.confirm_tickets_asof(t, events, cell=cell).orderBy("arrival").collect()
        assert [(r["ticket_id"], r["request_no"], r["remainingTickets"], r["confirmationStatus"]) for r in out] == [
            ("#10", 1, 1.0, "CONFIRMED"), ("#11", 2, 0.0, "CONFIRMED"), ("#12", 3, -1.0, "REJECTED"), ("#21", 4, -2.0, "REJECTED"),
            ("#41", 5, -3.0, "REJECTED")]


def test_a_null_capacity_is_not_answered(spark):
    t, e, _, _ = sale(spark, 1, 12)
    assert J.confirm_tickets(joined(t, e.withColumn("capacity", F.lit(None).cast("int")))).count() == 0


def test_confirmation_records(spark):
    t, e, _, _ = sale(spark, 3, 20)
    rows = J.confirmation_records(J.confirm_tickets(joined(t, e)), e).collect()
    assert rows and set(rows[0].asDict()) == {"eventid", "confirmationStatus", "confirmationId", "ticketRequest", "event", "remainingTickets"}
    assert all(r["event"]["id"] == r["eventid"] == r["ticketRequest"]["eventid"] for r in rows)


# ---------------------------------------------------------------- P3

@pytest.mark.parametrize("seed", SEEDS)
def test_conversions(spark, seed):
    """A record counts if, with all records up to it, its customer has both heard and bought some artist."""
    rng = random.Random(seed)
    ids = rng.sample(range(1000), 70)
    rows = []
    for i, x in enumerate(ids):
        side = rng.choice([0, 0, 1])
        rows.append((rng.choice(["u", "u", "v", None]), rng.choice("abcd"), at(i // 5), side, x if side == 0 else None, f"t{x:03d}" if side else None))
    df = spark.createDataFrame(rows, "customerid string, artistid string, time timestamp, side int, lid bigint, tid string")
    ordered = sorted((r for r in rows if r[0]), key=lambda r: (r[2], r[3], -1 if r[4] is None else r[4], r[5] or ""))

    def converted(upto, who):
        sides = [{r[1] for r in ordered[:upto + 1] if r[0] == who and r[3] == s} for s in (0, 1)]
        return bool(sides[0] & sides[1])

    want = [r for i, r in enumerate(ordered) if converted(i, r[0])]
    assert 0 < len(want) < len(ordered)
    assert J.conversion_matches(df).count() == len(want)
    got = J.conversion_tally_from(df, whole_table(3 * SECOND)).orderBy("value").collect()
    assert [(r["customerid"], r["lid"], r["tid"], r["value"]) for r in got] == [(r[0], r[4], r[5], i + 1) for i, r in enumerate(want)]


# ---------------------------------------------------------------- P4

@pytest.mark.parametrize("seed", SEEDS)
def test_revenue_leader(spark, seed):
    t, e, tickets, events = sale(spark, seed)
    known = spark.createDataFrame([("act0", "Zero", "x"), ("act1", "One", "y")], "id string, name string, genre string")
    rows = sorted((x for x in tickets if x[2] in events and events[x[2]][1] is not None), key=lambda x: (x[4], x[0], x[3]))
    totals = [(events[x[2]][1], sum(int(y[3]) for y in rows[:i + 1] if events[y[2]][1] == events[x[2]][1])) for i, x in enumerate(rows)]
    shown = [(x[0], i) for i, x in enumerate(rows) if totals[i][0] in ("act0", "act1")]

    def leader(upto):
        seen = [totals[i] for _, i in shown if i <= upto]
        best = max(v for _, v in seen)
        return next((a, v) for a, v in seen if v == best)

    want = {ticket: leader(i) for ticket, i in shown}
    for ch in (J.revenue_leader_changelog_from(joined(t, e), known, cell=5 * SECOND),
               J.revenue_leader_by_scans(joined(t, e), known, whole_table(5 * SECOND))):
        assert {r["ticket_id"]: (r["artistId"], r["revenue"]) for r in ch.collect()} == want
    end = J.revenue_leader_snapshot_from(joined(t, e), known, cell=5 * SECOND).first()
    assert (end["artistId"], end["revenue"]) == want[shown[-1][0]]
    assert J.revenue_leader_changelog_from(joined(t, e).where("eventid = 'none'"), known).count() == 0


# ---------------------------------------------------------------- P5

@pytest.mark.parametrize("seed", SEEDS)
def test_top_streamers_and_their_changelog(spark, seed):
    """Listens arrive out of order; windows of ten seconds close one second after their end."""
    rng = random.Random(seed)
    rows = [(str(i), rng.choice(["u", "u", "v", "stranger"]), rng.choice(["a", "b", "nobody"]), max(0, i // 2 - rng.choice([0, 0, 3, 14])), i) for i in range(90)]
    df = spark.createDataFrame([(i, c, a, at(s), p) for i, c, a, s, p in rows],
                               "id string, customerid string, artistid string, streamtime timestamp, pos bigint")
    timely = [r for i, r in enumerate(rows) if (r[3] // 10 + 1) * 10 > max(x[3] for x in rows[:i + 1]) - 1]
    assert len(timely) < len(rows)
    got = J.windowed_stream_counts_from(df, 10, 1, arrival_order=J.listen_pos(), cell=8).collect()
    want = Counter((r[2], r[1], r[3] // 10) for r in timely)
    assert Counter({(r["artistid"], r["customerid"], int((r["window_start"] - at(0)).total_seconds()) // 10): r["n"] for r in got}) == want
    artists = spark.createDataFrame([("a",), ("b",)], "id string")
    customers = spark.createDataFrame([("u",), ("v",)], "id string")

    def best(upto, artist):
        mine = [r for r in timely if r[4] <= upto and r[2] == artist]
        reached = [(Counter((x[1], x[3] // 10) for x in mine[:i + 1])[(r[1], r[3] // 10)], r[1]) for i, r in enumerate(mine)]
        most = max(n for n, _ in reached)
        return next((who, n) for n, who in reached if n == most)

    bests = {r[4]: (r[2], *best(r[4], r[2])) for r in timely if r[2] != "nobody"}
    ch = J.thank_you_changelog_from(df, artists, customers, 10, 1, whole_table(8)).collect()
    assert {r["pos"]: (r["artistId"], r["customerId"], r["streamCount"]) for r in ch} == {p: b for p, b in bests.items() if b[1] != "stranger"}
    counts = J.windowed_stream_counts_from(df, 10, 1, arrival_order=J.listen_pos(), cell=8)
    snap = {r["artistId"]: (r["customerId"], r["streamCount"]) for r in J.thank_you_from(counts, artists, customers).collect()}
    assert set(snap) <= {"a", "b"}


# ---------------------------------------------------------------- P6 to P9

def test_target_customers(spark):
    rows = [("k1", "1989-12-31"), ("k2", "1990-01-01"), ("k3", "1999-12-31"), ("k4", "2000-01-01"), ("k5", "soon"), ("k6", None)]
    c = spark.createDataFrame(rows, "id string, birthdt string")
    assert sorted(r["id"] for r in J.target_customers_from(c).collect()) == ["k2", "k3"]


def test_addresses(spark):
    rows = [("9 Elm Row", "Rear", "Ely", "NV", "89301", "0001", "USA"), ("7 Oak Way", None, "Orr", "MN", "55771", "0002", "USA")]
    a = spark.createDataFrame(rows, "line1 string, line2 string, citynm string, state string, zip5 string, zip4 string, countrycd string")
    out = {r["key"]: (r["value"], r["sink"]) for r in J.address_split_from(a).collect()}
    assert out == {"NV": ("9 Elm Row, Rear, Ely, NV 89301-0001 USA", "default"), "MN": ("7 Oak Way, , Orr, MN 55771-0002 USA", "priority")}


def test_running_counts(spark, listens):
    pairs = [("u", "a"), ("v", "a"), ("u", "b"), (None, "a"), ("u", "a"), ("v", "c")]
    out = J.customer_stream_count_changelog_from(listens(pairs), whole_table(2)).orderBy("streamtime").collect()
    assert [(r["customerid"], r["n"]) for r in out] == [("u", 1), ("v", 1), ("u", 2), ("u", 3), ("v", 2)]
    t, e, tickets, events = sale(spark, 5, 30)
    got = {r["ticket_id"]: (r["artistid"], r["n"]) for r in J.artist_ticket_count_changelog_from(joined(t, e), whole_table(2 * SECOND)).collect()}
    rows = sorted((x for x in tickets if x[2] in events and events[x[2]][1]), key=lambda x: (x[4], x[0], x[3]))
    acts = [events[x[2]][1] for x in rows]
    assert got == {x[0]: (acts[i], acts[:i + 1].count(acts[i])) for i, x in enumerate(rows)}


def test_alerts_count_listens_before_the_announcement(spark):
    listens = spark.createDataFrame([(c, a, str(i), at(t), i) for i, (c, a, t) in enumerate(
        [("u", "A", 1), ("v", "A", 1), ("v", "A", 2), ("w", "A", 3), ("u", "A", 4), ("u", "A", 4), ("x", "B", 4), (None, "A", 1)])],
        "customerid string, artistid string, id string, streamtime timestamp, pos bigint")
    events = spark.createDataFrame([(1, "A", at(1)), (2, "A", at(2)), (3, "A", at(4)), (4, "A", at(9)), (5, "B", at(4)), (6, "C", at(9))],
                                   "id int, artistid string, created timestamp")
    got = R.alerts_asof(events, listens, 2).collect()
    assert sorted((r["eventid"], r["rank"], r["customerid"], r["n"]) for r in got) == [
        (2, 1, "u", 1), (2, 2, "v", 1), (3, 1, "v", 2), (3, 2, "u", 1), (4, 1, "u", 3), (4, 2, "v", 2)]
