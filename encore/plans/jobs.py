"""The streaming jobs of the reference, in batch form.

Every job has a *snapshot* form (state after all input) and, where the
reference emits one record per input, a *changelog* form (one row per input,
in arrival order). Arrival order:

* listens: ``pos``, the record sequence number (equal to ``(streamtime, id)`` order)
* tickets: ``(arrival, id, price)`` -- unique at every scale
* merged listens + tickets (P3): ``(time, side, id)`` with side 0 = listen

The streaming forms are in ``encore.streaming.jobs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import functions as fx
from encore.operators.enrich import enrich_asof, tagged
from encore.operators.keyed import arg_max_first, first_seen
from encore.operators.route import route
from encore.operators.running import RECORDS, Spec, hot_keys, prefix_scan, running_leader
from encore.operators.sketch import TRACKED, counters, frequent
from encore.operators.tables import outer_changelog, withdrawn_sum
from encore.operators.topk import top_k_per_group
from encore.operators.windows import drop_late_records, still_open, tumbling_counts, window_start
from encore.sources import domain
from encore.streaming.carried import Scan, whole_table
from encore.streaming.sinks import from_records, to_records

# Fixed values of the jobs.
TOP_ARTISTS = 3                 # artists reported per customer
TARGET_BIRTH_FIRST = "1990-01-01"
TARGET_BIRTH_LAST = "1999-12-31"
WINDOW_SECONDS = 10             # tumbling window of the top-streamer job
GRACE_SECONDS = 1
PRIORITY_STATE_DEFAULT = "MN"
# On the test data the states are region names; ASIA plays the priority state.
PRIORITY_STATE_TESTDATA = "ASIA"
# Listens are ~1 per 260 s per customer-artist at sf0.01, so 10 s windows
# almost always count 1; the registered queries use a one-day window.
QUERY_WINDOW_SECONDS = 86400
TOPK_SALT = 8


def listen_pos() -> list[Column]:
    """Listen arrival order: the record's sequence number."""
    return [F.col("pos")]


def ticket_pos() -> list[Column]:
    return [F.col("arrival"), F.col("id"), F.col("price")]


def _event_cols(spark, sf_dir) -> DataFrame:
    return domain.event(spark, sf_dir).select(
        F.col("id").alias("eventid"), "artistid", "venueid", "capacity", "eventdate")


def _tickets_with_event(spark, sf_dir, with_customer=True) -> DataFrame:
    """Tickets inner-joined to their event (a ticket for an unknown event is dropped)."""
    return domain.ticket(spark, sf_dir, with_customer=with_customer).join(_event_cols(spark, sf_dir), "eventid")


# ---------------------------------------------------------------- P1

def artist_counts(listens: DataFrame) -> DataFrame:
    """Per (customer, artist): listen count, first and last position."""
    pos = F.col("pos")
    return (listens.where(F.col("customerid").isNotNull())
                   .groupBy("customerid", "artistid")
                   .agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first_pos"), F.max(pos).alias("last_pos")))


def top_customer_artists_from(listens: DataFrame, k: int = TOP_ARTISTS, salt_buckets: int = TOPK_SALT) -> DataFrame:
    """Every artist of a customer counts. Ties: who reached the count first."""
    top = top_k_per_group(artist_counts(listens), "customerid", [F.desc("n"), F.col("last_pos")], k,
                          salt_buckets=salt_buckets, salt=F.xxhash64("artistid"))
    return top.select("customerid", "rank", "artistid", "n")


def topk_salt(spark: SparkSession) -> int:
    """Salt buckets for two-phase top-k: one per core of the cluster (at least
    ``TOPK_SALT``), so a hot group's first phase is spread over the cluster;
    the second phase sees at most k x salt rows per group."""
    return max(TOPK_SALT, spark.sparkContext.defaultParallelism)


def top_customer_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_customer_artists_from(domain.listen(spark, sf_dir), salt_buckets=topk_salt(spark))


def top_customer_artists_changelog_from(listens: DataFrame, k: int = TOP_ARTISTS, scan: Scan = whole_table()) -> DataFrame:
    """The customer's ``k`` most streamed artists after every listen: ``customerid, listen_id, pos, top``.

    The ``j``-th greatest count is the greatest one that ``j`` artists have
    reached, and of the artists that reached it, the first that does not rank
    higher already has the place (ties go to who reached the count first). So
    four running aggregates give the answer, and none holds a customer or an
    artist map in one task: the count of (customer, artist); the how-manieth
    artist of the customer to reach that count; the first ``k`` artists to
    reach it; and the greatest counts reached by 1, 2, ... ``k`` artists.
    """
    order = listen_pos()
    rows = listens.where("customerid is not null").select(
        "customerid", "id", "pos", "artistid", F.struct("customerid", "artistid").alias("pair"))  # a null artist is one too
    counted = scan("count", rows, ["pair"], order, "pos", [Spec("n", "count")]).drop("pair")
    reached = scan("reached", counted, ["customerid", "n"], order, "pos", [Spec("r", "count")])
    who = [Spec(f"a{j}", "max", F.when(F.col("r") == j, F.struct("artistid"))) for j in range(1, k + 1)]
    named = scan("first", reached, ["customerid", "n"], order, "pos", who)
    named = named.select("customerid", "id", "pos", "n", "r", *[f"a{j}" for j in range(1, k + 1)])
    most = [Spec(f"best{j}", "max", F.when(F.col("r") == j, F.struct("n", F.array(*[f"a{i}" for i in range(1, j + 1)]).alias("who"))))
            for j in range(1, k + 1)]
    best = scan("best", named, ["customerid"], order, "pos", most)
    return best.select("customerid", F.col("id").alias("listen_id"), "pos", _places(k).alias("top"))


def _places(k: int) -> Column:
    """``array<struct<artistid, n>>`` from ``best1`` to ``bestk``."""
    out = None
    for j in range(1, k + 1):
        best = F.col(f"best{j}")
        free = best["who"] if out is None else F.array_except(best["who"], F.transform(out, lambda t: F.struct(t["artistid"].alias("artistid"))))
        place = F.array(F.struct(F.get(free, F.lit(0))["artistid"].alias("artistid"), best["n"].alias("n")))
        out = place if out is None else F.when(best.isNull(), out).otherwise(F.concat(out, place))
    return out


def flat_top(changelog: DataFrame, k: int = TOP_ARTISTS) -> DataFrame:
    """The changelog with a column per place."""
    places = [F.get("top", F.lit(j))[f].alias(f"{name}{j + 1}") for j in range(k) for f, name in (("artistid", "artist"), ("n", "n"))]
    return changelog.select("customerid", "listen_id", *places)


def top_customer_artists_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_top(top_customer_artists_changelog_from(domain.listen(spark, sf_dir)))


def artist_rank_changelog_from(listens: DataFrame, scan: Scan = whole_table()) -> DataFrame:
    """Any place, not only the first few: after every listen the rank of its artist among the customer's, ``rank``, and
    how many there are, ``artists``. Ties go to who reached the count first.

    A count is reached one listen at a time, once by every artist that gets so
    far. So the artists at or above the count that this listen reaches are
    those that reached it before, and the rank is the how-manieth this one is.
    """
    order = listen_pos()
    rows = listens.where("customerid is not null").select(
        "customerid", "id", "pos", "artistid", F.struct("customerid", "artistid").alias("pair"))
    counted = scan("count", rows, ["pair"], order, "pos", [Spec("n", "count")]).drop("pair")
    ranked = scan("reached", counted, ["customerid", "n"], order, "pos", [Spec("rank", "count")])
    known = scan("artists", ranked, ["customerid"], order, "pos", [Spec("artists", "count", F.when(F.col("n") == 1, 1))])
    return known.select("customerid", F.col("id").alias("listen_id"), "artistid", "n", "rank", "artists")


def artist_rank_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artist_rank_changelog_from(domain.listen(spark, sf_dir))


def customer_artist_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens per (customer, artist) from counters of bounded size, with the bound of each count."""
    sketches = counters(domain.listen(spark, sf_dir).where("customerid is not null"), ["customerid"], "artistid")
    return frequent(sketches, ["customerid"], "artistid", TRACKED)


def top_customer_artists_nested(flat: DataFrame) -> DataFrame:
    """``(customerid, top array<struct<artistid, n>>)`` ordered by rank; at most
    k elements per customer, so the collect is bounded."""
    return (flat.groupBy("customerid")
                .agg(F.sort_array(F.collect_list(F.struct("rank", "artistid", "n"))).alias("t"))
                .select("customerid", F.transform("t", lambda x: F.struct(x["artistid"].alias("artistid"),
                                                                          x["n"].alias("n"))).alias("top")))


# ---------------------------------------------------------------- P2

REQUEST = ("id", "customerid", "eventid", "price", "arrival", "capacity")


def confirm_tickets(joined: DataFrame, scan: Scan = whole_table()) -> DataFrame:
    """One confirmation per ticket joined to its event.

    ``joined`` has ticket columns plus the event's ``capacity``. An event's
    capacity is the one its first request sees; every request, rejected ones
    included, uses a seat, so ``remaining = capacity - n`` can go negative. A
    request that sees a null capacity is not answered and takes no seat.
    """
    rows = joined.where("capacity is not null").select(*REQUEST)
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(ticket_pos())])
    n = scan("requests", rows, ["eventid"], ticket_pos(), "arrival",
             [Spec("n", "count"), Spec("first", "min", F.struct(place.alias("at"), "capacity"))])
    return confirmations(n.withColumn("capacity", F.col("first.capacity")))


def confirmations(numbered: DataFrame) -> DataFrame:
    """The answer to each request, from its number ``n`` and the event's ``capacity``."""
    remaining = (F.col("capacity") - F.col("n")).cast("double")
    pct = fx.remaining_percentage(remaining, F.col("capacity"))
    return numbered.select(
        "eventid", F.col("id").alias("ticket_id"), "customerid", "price", "arrival",
        F.col("n").alias("request_no"),
        remaining.alias("remainingTickets"),
        F.when(remaining < 0, "REJECTED").otherwise("CONFIRMED").alias("confirmationStatus"),
        F.when(remaining < 0, "NONE").when(remaining == 0, "SOLD_OUT_NOW")
         .when(pct <= fx.LIMITED_PERCENT, "LIMITED").otherwise("AVAILABLE").alias("availability"),
        fx.stable_id(F.col("id"), F.col("eventid"), F.col("n")).alias("confirmationId"),
    )


def confirm_tickets_asof(tickets: DataFrame, events: DataFrame, event_time: str = "updated",
                         cell: int | None = None, hot: DataFrame | None = None) -> DataFrame:
    """P2 with the event table as a changelog joined *as of* each ticket's
    arrival (a stream-table join): a ticket that arrives before its event
    exists, or after it was deleted (a row with a null ``capacity``), is
    dropped. The first ticket that sees the event fixes its capacity; later
    changes of the table do not. ``events``: ``id, capacity, <event_time>``. ``hot``
    are the events that have cells, by default all."""
    j = enrich_asof(tickets.select("id", "customerid", "eventid", "price", "arrival"), events, "eventid", "id", "arrival",
                    event_time, ["id", "price"], ["id"], ["capacity"], tombstone=F.col("capacity").isNull(), cell=cell, hot=hot)
    return confirm_tickets(j, whole_table(cell, None if hot is None else {"requests": hot}))


def ticket_and_event_records(tickets: DataFrame, events: DataFrame, event_time: str = "updated") -> DataFrame:
    """Tickets and changes of the event table as one stream of records, in the order (time, table first, id, price)."""
    return tagged(tickets.select("id", "customerid", "eventid", "price", "arrival"), events, "eventid", "id", "arrival", event_time,
                  ["id", "price"], ["id"], ["capacity"], tombstone=F.col("capacity").isNull())


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with so many tickets that their running values are computed in cells."""
    return hot_keys(domain.ticket(spark, sf_dir, with_customer=False).where("eventid is not null"), ["eventid"])


def purchase_event_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confirm_tickets(_tickets_with_event(spark, sf_dir), whole_table(hot={"requests": hot_events(spark, sf_dir)}))


def purchase_event_ticket_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 over an event table that changes while tickets arrive."""
    return confirm_tickets_asof(domain.ticket(spark, sf_dir), domain.event_changes(spark, sf_dir), hot=hot_events(spark, sf_dir))


def confirmation_records(confirmations: DataFrame, events: DataFrame) -> DataFrame:
    """The nested record shape: ``ticketRequest`` and ``event`` structs."""
    e = events.select(F.col("id").alias("eventid"),
                      F.struct("id", "artistid", "venueid", "capacity", "eventdate").alias("event"))
    c = confirmations.join(e, "eventid")
    return c.select("eventid", "confirmationStatus", "confirmationId",
                    F.struct(F.col("ticket_id").alias("id"), "customerid", "eventid", "price").alias("ticketRequest"),
                    "event", "remainingTickets")


# ---------------------------------------------------------------- P3

def conversion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens and event-joined tickets as one record stream:
    ``(customerid, artistid, time, side, lid, tid)``; side 0 = listen, 1 = purchase."""
    l = domain.listen(spark, sf_dir).select(
        "customerid", "artistid", F.col("streamtime").alias("time"), F.lit(0).alias("side"),
        F.col("id").alias("lid"), F.lit(None).cast("string").alias("tid"))
    t = _tickets_with_event(spark, sf_dir).select(
        "customerid", "artistid", F.col("arrival").alias("time"), F.lit(1).alias("side"),
        F.lit(None).cast("bigint").alias("lid"), F.col("id").alias("tid"))
    return l.unionByName(t).where(F.col("customerid").isNotNull())


def _conv_pos() -> Column:
    return F.struct("time", "side", "lid", "tid")


def conversion_matches(e: DataFrame) -> DataFrame:
    """Rows of ``e`` that re-emit a true match: at or after the customer's first
    moment with a listened-and-purchased artist. Sets only grow, so once
    matched a customer stays matched."""
    pos = _conv_pos()
    f = e.groupBy("customerid", "artistid").agg(
        F.min(F.when(F.col("side") == 0, pos)).alias("l"),
        F.min(F.when(F.col("side") == 1, pos)).alias("p"))
    m = (f.where(F.col("l").isNotNull() & F.col("p").isNotNull())
          .groupBy("customerid").agg(F.min(F.greatest("l", "p")).alias("first_match")))
    return e.join(m, "customerid").where(pos >= F.col("first_match"))


def customer_conversion_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (conversion_matches(conversion_events(spark, sf_dir))
            .agg(F.count(F.lit(1)).alias("value"))
            .select(F.lit(fx.TALLY_KEY).alias("key"), "value"))


def conversion_tally_from(e: DataFrame, scan: Scan) -> DataFrame:
    """The tally after each record that re-emits a true match, by running aggregates alone: whether each side of
    (customer, artist) has occurred, whether the customer has matched, how many records of matched customers there were."""
    order = [F.col(c) for c in ("time", "side", "lid", "tid")]
    rows = e.where("customerid is not null").select("customerid", "time", "side", "lid", "tid", F.struct("customerid", "artistid").alias("pair"))
    sides = [Spec("heard", "max", (F.col("side") == 0).cast("int")), Spec("bought", "max", (F.col("side") == 1).cast("int"))]
    seen = scan("sides", rows, ["pair"], order, "time", sides).drop("pair")
    hit = seen.withColumn("hit", F.least("heard", "bought")).drop("heard", "bought")
    matched = scan("matched", hit, ["customerid"], order, "time", [Spec("matched", "max", "hit")]).where("matched = 1")
    rows = matched.select("customerid", "time", "side", "lid", "tid")
    return scan("tally", rows, [], order, "time", [Spec("value", "count")]).select(F.lit(fx.TALLY_KEY).alias("key"), "*")


def customer_conversion_tally_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = conversion_matches(conversion_events(spark, sf_dir)).select("customerid", "time", "side", "lid", "tid")
    r = prefix_scan(m, [], [F.col("time"), F.col("side"), F.col("lid"), F.col("tid")], "time", [Spec("value", "count")])
    return r.select(F.lit(fx.TALLY_KEY).alias("key"), "customerid", "time", "side", "lid", "tid", "value")


def match_changelog_from(e: DataFrame, scan: Scan = whole_table()) -> DataFrame:
    """Whether a customer bought a ticket for a listened artist, after every listen and purchase of theirs, and whether
    so before it (null at their first): the full outer join of the listens and the purchases by (customer, artist), and
    per customer the number of pairs that both sides have, from which an update takes back what the old row gave."""
    order = [F.col(c) for c in ("time", "side", "lid", "tid")]
    rows = e.where("customerid is not null").select(
        "customerid", "time", "side", "lid", "tid", F.struct("customerid", "artistid").alias("pair"), F.lit(1).alias("there"))
    pairs = outer_changelog(rows, "pair", order, "time", "side", "there", scan, "pairs")
    both = {s: (F.col(f"{s}.left").isNotNull() & F.col(f"{s}.right").isNotNull()).cast("int").alias(s) for s in ("old", "new")}
    steps = pairs.select("customerid", "time", "side", "lid", "tid", *both.values())
    matched = withdrawn_sum(steps, ["customerid"], order, "time", F.col("old"), F.col("new"), scan, "pairs", "matches")
    return matched.select("customerid", "time", "side", "lid", "tid", (F.col("old_pairs") > 0).alias("old_match"),
                          (F.col("new_pairs") > 0).alias("new_match"))


def customer_match_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_changelog_from(conversion_events(spark, sf_dir))


# ---------------------------------------------------------------- P4

def artist_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per artist: each ticket's price truncated to a whole number, then summed."""
    t = domain.ticket(spark, sf_dir, with_customer=False)
    per_event = t.groupBy("eventid").agg(F.sum(F.col("price").cast("bigint")).alias("revenue"))
    e = _event_cols(spark, sf_dir).select("eventid", "artistid")
    return per_event.join(e, "eventid").groupBy("artistid").agg(F.sum("revenue").alias("revenue"))


def running_revenue(t: DataFrame, artists: DataFrame, scan: Scan = whole_table()) -> DataFrame:
    """Each ticket with its artist's running revenue ``total``, for known artists.

    ``t``: tickets joined to their event (``id, price, arrival, artistid``).
    """
    rows = t.select("id", "price", "arrival", "artistid")
    totals = scan("revenue", rows, ["artistid"], ticket_pos(), "arrival", [Spec("total", "sum", F.col("price").cast("bigint"))])
    a = artists.select(F.col("id").alias("artistid"), F.col("name").alias("artist_name"), F.col("genre").alias("artist_genre"))
    return totals.join(a, "artistid")


def revenue_leader_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_leader_changelog_from(_tickets_with_event(spark, sf_dir, with_customer=False), domain.artist(spark, sf_dir))


def revenue_leader_changelog_from(t: DataFrame, artists: DataFrame, cell: int | None = None) -> DataFrame:
    """The leader re-emitted after every ticket (with known event and artist).

    A row sets a record when its artist's running total is strictly greater
    than every earlier row's total; the leader is the last record at or before
    the row (it holds on ties, and is a high-water mark if totals fall).
    """
    led = running_leader(running_revenue(t, artists, whole_table(cell)), ticket_pos(), "arrival", "total",
                         ["artistid", "artist_name", "artist_genre"], out="leader", cell=cell)
    return _leader_rows(led)


def _leader_rows(led: DataFrame) -> DataFrame:
    return led.select(F.lit(fx.LEADER_KEY).alias("key"), F.col("id").alias("ticket_id"), "arrival", "price",
                      F.col("leader.artistid").alias("artistId"), F.col("leader.artist_name").alias("artist_name"),
                      F.col("leader.artist_genre").alias("artist_genre"), F.col("leader.total").alias("revenue"))


def revenue_leader_by_scans(t: DataFrame, artists: DataFrame, scan: Scan) -> DataFrame:
    """The same changelog by running aggregates alone: tickets are numbered, and the leader is the running maximum of
    (total, the earlier the better)."""
    numbered = scan("number", running_revenue(t, artists, scan), [], ticket_pos(), "arrival", [Spec("nth", "count")])
    leader = F.struct("total", F.negative("nth").alias("at"), "artistid", "artist_name", "artist_genre")
    return _leader_rows(scan("leader", numbered, [], ticket_pos(), "arrival", [Spec("leader", "max", leader)]))


def artist_revenue_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_leader_snapshot_from(_tickets_with_event(spark, sf_dir, with_customer=False), domain.artist(spark, sf_dir))


def revenue_leader_snapshot_from(t: DataFrame, artists: DataFrame, cell: int | None = None) -> DataFrame:
    """Current leader after all tickets (the changelog's last row), without the
    changelog: records rise strictly, so the last record is the first row in
    arrival order at the greatest running total, one aggregate over the rows."""
    reports = running_revenue(t, artists, whole_table(cell)).withColumn("key", F.lit(fx.LEADER_KEY))
    first = arg_max_first(reports, "key", "total", ticket_pos(), ["artistid", "artist_name", "artist_genre"])
    return first.select("key", F.col("artistid").alias("artistId"), "artist_name", "artist_genre", F.col("total").alias("revenue"))


# ---------------------------------------------------------------- P5

def windowed_stream_counts_from(listens: DataFrame, size_seconds: int, grace_seconds: int,
                                arrival_order: list[Column] | None = None, arrival_time: str = "pos",
                                cell: int | None = None) -> DataFrame:
    """Count per (artist, customer, tumbling window), late records dropped."""
    kept = listens.select("artistid", "customerid", "streamtime", "pos")
    if arrival_order is not None:
        kept = drop_late_records(kept, "streamtime", arrival_order, arrival_time, size_seconds, grace_seconds, cell=cell)
    return tumbling_counts(kept, ["artistid", "customerid"], "streamtime", size_seconds,
                           last_order=F.col("pos"))


def windowed_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = domain.listen(spark, sf_dir)
    c = windowed_stream_counts_from(l, QUERY_WINDOW_SECONDS, GRACE_SECONDS, arrival_order=listen_pos())
    return c.select("artistid", "customerid", "window_start", "window_end", "n")


def thank_you_from(counts: DataFrame, artists: DataFrame, customers: DataFrame) -> DataFrame:
    """Per artist the best single-window count (first to reach it wins), for
    known artists and customers. Name and email are placeholders here (the
    customer id and empty text), as in the reference job."""
    best = arg_max_first(counts, "artistid", "n", [F.col("last_pos")], ["customerid"], value_name="streamCount")
    best = best.join(artists.select(F.col("id").alias("artistid")), "artistid", "left_semi")
    best = best.join(customers.select(F.col("id").alias("customerid")), "customerid", "left_semi")
    return best.select(F.col("customerid").alias("customerId"), F.col("customerid").cast("string").alias("customerName"),
                       F.col("artistid").alias("artistId"), F.lit("").alias("artistName"), F.lit("").alias("email"),
                       "streamCount")


def thank_you_top_streamer(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windowed_stream_counts_from(domain.listen(spark, sf_dir), QUERY_WINDOW_SECONDS, GRACE_SECONDS,
                                         arrival_order=listen_pos())
    return thank_you_from(counts, domain.artist(spark, sf_dir), domain.customer(spark, sf_dir))


def windowed_counts_changelog_from(listens: DataFrame, size_seconds: int, grace_seconds: int, scan: Scan = whole_table(),
                                   partition: str | None = None) -> DataFrame:
    """P5a per update: the count ``n`` of (artist, customer, window) after every listen that is not late. With
    ``partition``, the column of the source partition, each partition has a stream time of its own."""
    order, source = listen_pos(), [partition] if partition else []
    rows = listens.select("artistid", "customerid", "streamtime", "pos", *source)
    clock = scan("clock", rows, source, order, "pos", [Spec("now", "max", F.col("streamtime").cast("timestamp"))])
    kept = still_open(clock, "streamtime", "now", size_seconds, grace_seconds)
    kept = kept.select("artistid", "customerid", "pos", window_start("streamtime", size_seconds).alias("window_start"))
    return scan("windows", kept, ["artistid", "customerid", "window_start"], order, "pos", [Spec("n", "count")])


def thank_you_changelog_from(listens: DataFrame, artists: DataFrame, customers: DataFrame, size_seconds: int,
                             grace_seconds: int, scan: Scan = whole_table()) -> DataFrame:
    """P5 per update: after every listen that counts, its artist's best single-window count so far, changed or not.

    The best is kept over all customers and artists; only what is published
    asks whether both are known, so an unknown best hides lesser ones.
    """
    order = listen_pos()
    counted = windowed_counts_changelog_from(listens, size_seconds, grace_seconds, scan)
    best = scan("best", counted.select("artistid", "customerid", "pos", "n"), ["artistid"], order, "pos",
                [Spec("best", "max", F.struct("n", F.negative("pos").alias("at"), "customerid"))])
    out = best.select("artistid", "pos", F.col("best.customerid").alias("customerid"), F.col("best.n").alias("streamCount"))
    out = out.join(artists.select(F.col("id").alias("artistid")), "artistid", "left_semi")
    out = out.join(customers.select(F.col("id").alias("customerid")), "customerid", "left_semi")
    return out.select("pos", F.col("customerid").alias("customerId"), F.col("customerid").cast("string").alias("customerName"),
                      F.col("artistid").alias("artistId"), F.lit("").alias("artistName"), F.lit("").alias("email"), "streamCount")


def thank_you_top_streamer_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thank_you_changelog_from(domain.listen(spark, sf_dir), domain.artist(spark, sf_dir), domain.customer(spark, sf_dir),
                                    QUERY_WINDOW_SECONDS, GRACE_SECONDS)


def late_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5a on listens that arrive out of order (``domain.listen_shuffled``), so that the late rule drops some."""
    c = windowed_stream_counts_from(domain.listen_shuffled(spark, sf_dir), QUERY_WINDOW_SECONDS, GRACE_SECONDS,
                                    arrival_order=listen_pos(), cell=RECORDS * domain.SHUFFLE_STEP)
    return c.select("artistid", "customerid", "window_start", "window_end", "n")


def partition_late_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5a on listens of two source partitions with different lag, each by its own stream time."""
    listens = domain.listen_partitioned(spark, sf_dir).where("artistid is not null and customerid is not null")
    kept = drop_late_records(listens, "streamtime", listen_pos(), "pos", QUERY_WINDOW_SECONDS, GRACE_SECONDS, ["partition"],
                             cell=RECORDS * domain.SHUFFLE_STEP)
    c = tumbling_counts(kept, ["artistid", "customerid"], "streamtime", QUERY_WINDOW_SECONDS)
    return c.select("artistid", "customerid", "window_start", "window_end", "n")


def listened_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's artists in the order they were first listened to."""
    seen = first_seen(domain.listen(spark, sf_dir).where("customerid is not null"), "customerid", "artistid", listen_pos())
    at = seen.select("customerid", "artistid", F.col("first_pos.__o0").alias("first_pos"))
    return prefix_scan(at, ["customerid"], [F.col("first_pos")], "first_pos", [Spec("nth", "count")])


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens as keyed JSON records and back, as a sink and a source of topics do."""
    listens = domain.listen(spark, sf_dir)
    return from_records(to_records(listens, "customerid"), listens.schema)


def tickets_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ticket with the capacity its event had on arrival; none before the event or after its deletion."""
    out = enrich_asof(domain.ticket(spark, sf_dir, with_customer=False), domain.event_changes(spark, sf_dir), "eventid", "id",
                      "arrival", "updated", ["id", "price"], ["id"], ["capacity"], tombstone=F.col("capacity").isNull())
    return out.select(F.col("id").alias("ticket_id"), "eventid", "arrival", "price", "capacity")


# ---------------------------------------------------------------- P6, P7

def target_customers_from(customers: DataFrame) -> DataFrame:
    return customers.where(fx.born_between("birthdt", TARGET_BIRTH_FIRST, TARGET_BIRTH_LAST))


def target_customer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_customers_from(domain.customer(spark, sf_dir))


def target_customer_filter_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = domain.customer(spark, sf_dir).unionByName(domain.customer_legacy(spark, sf_dir))
    return target_customers_from(merged)


def address_by_state_from(addresses: DataFrame) -> DataFrame:
    return addresses.select(F.col("state").alias("key"), fx.format_address().alias("value"))


def address_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address_by_state_from(domain.address(spark, sf_dir))


def address_split_from(addresses: DataFrame, priority_state: str = PRIORITY_STATE_DEFAULT) -> DataFrame:
    keyed = address_by_state_from(addresses)
    return route(keyed, [("priority", F.col("key") == priority_state)], default="default", out="sink")


def address_split_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address_split_from(domain.address(spark, sf_dir), PRIORITY_STATE_TESTDATA)


# ---------------------------------------------------------------- P8, P9

def customer_stream_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = domain.listen(spark, sf_dir).where(F.col("customerid").isNotNull())
    return l.groupBy("customerid").agg(F.count(F.lit(1)).alias("n"))


def customer_stream_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_stream_count_changelog_from(domain.listen(spark, sf_dir))


def customer_stream_count_changelog_from(listens: DataFrame, scan: Scan = whole_table()) -> DataFrame:
    l = listens.select("customerid", "id", "streamtime", "pos")
    r = scan("listens", l.where("customerid is not null"), ["customerid"], listen_pos(), "pos", [Spec("n", "count")])
    return r.select("customerid", F.col("id").alias("listen_id"), "streamtime", "n")


def artist_ticket_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = domain.ticket(spark, sf_dir, with_customer=False)
    per_event = t.groupBy("eventid").agg(F.count(F.lit(1)).alias("n"))
    e = _event_cols(spark, sf_dir).select("eventid", "artistid").where(F.col("artistid").isNotNull())
    return per_event.join(e, "eventid").groupBy("artistid").agg(F.sum("n").alias("n"))


def artist_ticket_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artist_ticket_count_changelog_from(_tickets_with_event(spark, sf_dir, with_customer=False))


def artist_ticket_count_changelog_from(tickets_with_event: DataFrame, scan: Scan = whole_table()) -> DataFrame:
    t = tickets_with_event.select("artistid", "id", "arrival", "price")
    r = scan("tickets", t.where("artistid is not null"), ["artistid"], ticket_pos(), "arrival", [Spec("n", "count")])
    return r.select("artistid", F.col("id").alias("ticket_id"), "arrival", "n")


# ---------------------------------------------------------------- P10, P11

def passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source to sink unchanged (the job template); here the listen records."""
    return domain.listen(spark, sf_dir)


def notices_from(confirmations: DataFrame, sender: str = fx.NOTICE_SENDER) -> DataFrame:
    return confirmations.select(
        "confirmationId",
        F.lit(sender).alias("sender"),
        fx.notice_recipient("customerid").alias("recipient"),
        fx.notice_subject("confirmationId", "eventid").alias("subject"),
        fx.notice_body("confirmationStatus").alias("body"),
    )


def ticket_confirmation_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices_from(purchase_event_ticket(spark, sf_dir))


QUERIES = {
    "top_customer_artists": top_customer_artists,
    "top_customer_artists_changelog": top_customer_artists_changelog,
    "artist_rank_changelog": artist_rank_changelog,
    "customer_artist_counters": customer_artist_counters,
    "customer_match_changelog": customer_match_changelog,
    "purchase_event_ticket_asof": purchase_event_ticket_asof,
    "thank_you_top_streamer_changelog": thank_you_top_streamer_changelog,
    "late_stream_counts": late_stream_counts,
    "partition_late_stream_counts": partition_late_stream_counts,
    "listened_artists": listened_artists,
    "json_round_trip": json_round_trip,
    "tickets_as_of": tickets_as_of,
    "purchase_event_ticket": purchase_event_ticket,
    "customer_conversion_tally": customer_conversion_tally,
    "customer_conversion_tally_changelog": customer_conversion_tally_changelog,
    "artist_revenue": artist_revenue,
    "artist_revenue_leader": artist_revenue_leader,
    "artist_revenue_leader_changelog": revenue_leader_changelog,
    "windowed_stream_counts": windowed_stream_counts,
    "thank_you_top_streamer": thank_you_top_streamer,
    "target_customer_filter": target_customer_filter,
    "target_customer_filter_merged": target_customer_filter_merged,
    "address_by_state": address_by_state,
    "address_split_priority": address_split_priority,
    "customer_stream_count": customer_stream_count,
    "customer_stream_count_changelog": customer_stream_count_changelog,
    "artist_ticket_count": artist_ticket_count,
    "artist_ticket_count_changelog": artist_ticket_count_changelog,
    "passthrough": passthrough,
    "ticket_confirmation_notices": ticket_confirmation_notices,
}
