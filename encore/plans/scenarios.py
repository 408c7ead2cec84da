"""The documented scenario goals, as batch jobs.

Scenario alerts that would pair every customer of a group with every event of
the group (R10, R11, R18) are delivered as one row per event and group with the
audience size, plus the recipient table keyed by the same group; expanding the
pairs is left to the delivery step. Emitting the pairs here would make the
output grow as customers x events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions import parse_event_time
from encore.operators.enrich import enrich_asof
from encore.operators.keyed import arg_max_first
from encore.operators.running import Spec, prefix_scan
from encore.operators.topk import top_k_per_group
from encore.plans import jobs as J
from encore.sources import domain

# Fixed values of the scenarios.
TOP_GLOBAL = 3
TOP_STREAMERS_PER_ARTIST = 3      # our choice for R6
NEAR_CAPACITY_NUM, NEAR_CAPACITY_DEN = 9, 10   # "within 10% of capacity" = 90% sold
DEFAULT_AS_OF = "1999-01-01 00:00:00"


def _near_threshold(capacity) -> F.Column:
    """ceil(0.9 * capacity) in exact integer arithmetic."""
    c = F.col(capacity) if isinstance(capacity, str) else capacity
    return ((c * NEAR_CAPACITY_NUM + (NEAR_CAPACITY_DEN - 1)).cast("bigint") / NEAR_CAPACITY_DEN).cast("bigint")


# ---------------------------------------------------------------- most streamed

def top_artists_global(spark: SparkSession, sf_dir: str, k: int = TOP_GLOBAL) -> DataFrame:
    c = domain.listen(spark, sf_dir).where(F.col("artistid").isNotNull()).groupBy("artistid").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "artistid").limit(k)


def customers_by_top_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers grouped by their top artist: one row per customer with the
    group key and group size (no per-group array, which a popular artist
    would make unbounded)."""
    top1 = J.top_customer_artists(spark, sf_dir).where(F.col("rank") == 1)
    sizes = top1.groupBy("artistid").agg(F.count(F.lit(1)).alias("group_size"))
    return top1.select("artistid", "customerid").join(sizes, "artistid")


# ---------------------------------------------------------------- sold out

def ticket_sequence(spark: SparkSession, sf_dir: str, cell: int | None = None) -> DataFrame:
    """Tickets joined to their event, with the running count per event."""
    t = J._tickets_with_event(spark, sf_dir, with_customer=False).select("eventid", "id", "price", "arrival", "artistid", "capacity")
    return prefix_scan(t, ["eventid"], J.ticket_pos(), "arrival", [Spec("sold", "count")], cell=cell,
                       hot=J.hot_events(spark, sf_dir)).drop("price")


def event_near_capacity_alert(spark: SparkSession, sf_dir: str, cell: int | None = None) -> DataFrame:
    """One alert per event, at the ticket that brings sales to 90% of capacity."""
    s = ticket_sequence(spark, sf_dir, cell)
    return (s.where(F.col("sold") == _near_threshold("capacity"))
             .select("eventid", "artistid", F.col("id").alias("ticket_id"), "arrival", "sold", "capacity"))


def event_sold_out_alert(spark: SparkSession, sf_dir: str, cell: int | None = None) -> DataFrame:
    s = ticket_sequence(spark, sf_dir, cell)
    return (s.where(F.col("sold") == F.col("capacity"))
             .select("eventid", "artistid", F.col("id").alias("ticket_id"), "arrival", "sold", "capacity"))


def _top_streamers(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    c = J.artist_counts(domain.listen(spark, sf_dir)).where(F.col("artistid").isNotNull())
    return top_k_per_group(c, "artistid", [F.desc("n"), F.col("last_pos")], k,
                           salt_buckets=J.topk_salt(spark), salt=F.xxhash64("customerid"))


def new_event_top_streamer_alert(spark: SparkSession, sf_dir: str, k: int = TOP_STREAMERS_PER_ARTIST) -> DataFrame:
    """For each event, the artist's top-k streamers (k rows per event)."""
    top = _top_streamers(spark, sf_dir, k).select("artistid", "customerid", "rank", "n")
    ev = domain.event(spark, sf_dir).select(F.col("id").alias("eventid"), "artistid")
    return ev.join(top, "artistid").select("eventid", "artistid", "customerid", "rank", "n")


def top_streamers_changelog_from(listens: DataFrame, k: int = TOP_STREAMERS_PER_ARTIST) -> DataFrame:
    """The artist's ``k`` top streamers after every listen, ``artistid, pos, top`` (``customerid, n``): the changelog of
    P1 with the parts of customer and artist exchanged."""
    swapped = listens.where("artistid is not null and customerid is not null").select(
        F.col("artistid").alias("customerid"), F.col("customerid").alias("artistid"), "id", "pos")
    log = J.top_customer_artists_changelog_from(swapped, k)
    top = F.transform("top", lambda t: F.struct(t["artistid"].alias("customerid"), t["n"].alias("n")))
    return log.select(F.col("customerid").alias("artistid"), "pos", top.alias("top"))


def new_event_top_streamer_alert_asof(spark: SparkSession, sf_dir: str, k: int = TOP_STREAMERS_PER_ARTIST) -> DataFrame:
    """For each event, its artist's top streamers when it was announced: an as-of join of the events to the changelog
    of top streamers. Listens from the announcement on do not count, and an artist without listens before it gives no row."""
    return alerts_asof(domain.event_created(spark, sf_dir), domain.listen(spark, sf_dir), k)


def alerts_asof(events: DataFrame, listens: DataFrame, k: int = TOP_STREAMERS_PER_ARTIST) -> DataFrame:
    """``events``: ``id, artistid, created``."""
    log = top_streamers_changelog_from(listens, k).join(
        listens.select("pos", F.col("streamtime").cast("timestamp").alias("at")), "pos")
    # Of listens at one time the last by ``pos`` counts; ties are compared as text.
    log = log.withColumn("place", F.lpad(F.col("pos").cast("string"), 19, "0"))
    seen = enrich_asof(events, log, "artistid", "artistid", "created", "at", ["id"], ["place"], ["top"], table_first=False)
    ranked = seen.select(F.col("id").alias("eventid"), "artistid", F.posexplode("top").alias("i", "t"))
    return ranked.select("eventid", "artistid", "t.customerid", (F.col("i") + 1).cast("bigint").alias("rank"), "t.n")


def new_event_top_streamer_email(spark: SparkSession, sf_dir: str, k: int = TOP_STREAMERS_PER_ARTIST) -> DataFrame:
    a = new_event_top_streamer_alert(spark, sf_dir, k)
    e = domain.one_per_customer(domain.email(spark, sf_dir)).select("customerid", "email")
    return a.join(e, "customerid", "left")


# ---------------------------------------------------------------- venues

def _global_arg_max(df: DataFrame, value: str, order, payload) -> DataFrame:
    g = df.withColumn("__all", F.lit(1))
    return arg_max_first(g, "__all", value, order, payload).drop("__all")


def venue_most_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = domain.event(spark, sf_dir).where(F.col("venueid").isNotNull())
    per_venue = ev.groupBy("venueid").agg(F.count(F.lit(1)).alias("events"))
    v = domain.venue(spark, sf_dir).select(F.col("id").alias("venueid"), F.col("name").alias("venue_name"))
    best = _global_arg_max(per_venue.join(v, "venueid", "left"), "events", [F.col("venueid")],
                           ["venueid", "venue_name"])
    return best.select("venueid", "venue_name", "events")


def venue_most_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = domain.ticket(spark, sf_dir).select("customerid", "eventid").where(F.col("customerid").isNotNull())
    ev = domain.event(spark, sf_dir).select(F.col("id").alias("eventid"), "venueid")
    pairs = t.join(ev, "eventid").select("venueid", "customerid").distinct()
    per_venue = pairs.groupBy("venueid").agg(F.count(F.lit(1)).alias("customers"))
    v = domain.venue(spark, sf_dir).select(F.col("id").alias("venueid"), F.col("name").alias("venue_name"))
    best = _global_arg_max(per_venue.join(v, "venueid", "left"), "customers", [F.col("venueid")],
                           ["venueid", "venue_name"])
    return best.select("venueid", "venue_name", "customers")


# ---------------------------------------------------------------- genre suggestions

def customer_top_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's most streamed genre (ties: first to reach the count)."""
    l = domain.listen(spark, sf_dir).where(F.col("customerid").isNotNull())
    a = domain.artist(spark, sf_dir).select(F.col("id").alias("artistid"), "genre")
    pos = F.col("pos")
    g = (l.join(a, "artistid").groupBy("customerid", "genre")
          .agg(F.count(F.lit(1)).alias("n"), F.max(pos).alias("last_pos")))
    return arg_max_first(g, "customerid", "n", [F.col("last_pos")], ["genre"])


def _genre_audience(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    audience = customer_top_genre(spark, sf_dir).groupBy("genre").agg(F.count(F.lit(1)).alias("audience"))
    a = domain.artist(spark, sf_dir).select(F.col("id").alias("artistid"), "genre")
    return events.join(a, "artistid").join(audience, "genre").select("eventid", "artistid", "genre", "audience")


def genre_event_suggestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: its genre and how many customers have it as their top genre
    (recipients: ``customer_top_genre`` joined on genre)."""
    ev = domain.event(spark, sf_dir).select(F.col("id").alias("eventid"), "artistid")
    return _genre_audience(spark, sf_dir, ev)


def genre_popular_event_suggestion(spark: SparkSession, sf_dir: str, cell: int | None = None) -> DataFrame:
    popular = event_near_capacity_alert(spark, sf_dir, cell).select("eventid", "artistid")
    return _genre_audience(spark, sf_dir, popular)


# ---------------------------------------------------------------- totals

def _total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("metric"), "total")


def total_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _total(domain.customer(spark, sf_dir), "customers")


def total_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _total(domain.listen(spark, sf_dir), "streams")


def total_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _total(domain.event(spark, sf_dir), "events")


def total_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _total(domain.ticket(spark, sf_dir, with_customer=False), "tickets")


def total_past_events(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    ev = domain.event(spark, sf_dir).where(parse_event_time("eventdate") < F.lit(as_of).cast("timestamp"))
    return _total(ev, "past_events")


# ---------------------------------------------------------------- location

def tickets_by_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets per customer zip code; tickets are first counted per customer."""
    per_cust = (domain.ticket(spark, sf_dir).where(F.col("customerid").isNotNull())
                .groupBy("customerid").agg(F.count(F.lit(1)).alias("n")))
    addr = domain.one_per_customer(domain.address(spark, sf_dir)).select("customerid", "zip5")
    return per_cust.join(addr, "customerid").groupBy("zip5").agg(F.sum("n").alias("tickets"))


def zip_popular_event_alert(spark: SparkSession, sf_dir: str, cell: int | None = None) -> DataFrame:
    """Per (zip, popular event) with at least one buyer in the zip: buyers, and
    the audience = residents of the zip who have not bought a ticket to it."""
    popular = event_near_capacity_alert(spark, sf_dir, cell).select("eventid")
    addr = domain.one_per_customer(domain.address(spark, sf_dir)).select("customerid", "zip5")
    buyers = (domain.ticket(spark, sf_dir).select("customerid", "eventid").where(F.col("customerid").isNotNull())
              .join(popular, "eventid", "left_semi").distinct()
              .join(addr, "customerid").groupBy("zip5", "eventid").agg(F.count(F.lit(1)).alias("buyers")))
    residents = addr.groupBy("zip5").agg(F.count(F.lit(1)).alias("residents"))
    return (buyers.join(residents, "zip5")
                  .select("zip5", "eventid", "buyers", "residents",
                          (F.col("residents") - F.col("buyers")).alias("audience")))


# ---------------------------------------------------------------- monthly top weekly streamer

def monthly_top_weekly_streamer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per artist and month, the customer with the most listens in one week
    (weeks start Monday; a week belongs to the month of its Monday), with
    name and email; ties go to who reached the count first."""
    l = domain.listen(spark, sf_dir).where(F.col("customerid").isNotNull() & F.col("artistid").isNotNull())
    wk = l.withColumn("week_start", F.date_trunc("week", "streamtime"))
    pos = F.col("pos")
    c = (wk.groupBy("artistid", "customerid", "week_start")
           .agg(F.count(F.lit(1)).alias("n"), F.max(pos).alias("last_pos"))
           .withColumn("month", F.date_trunc("month", "week_start")))
    best = arg_max_first(c, ["artistid", "month"], "n", [F.col("last_pos")], ["customerid", "week_start"])
    cust = domain.customer(spark, sf_dir).select(F.col("id").alias("customerid"), F.col("fullname").alias("customer_name"))
    em = domain.one_per_customer(domain.email(spark, sf_dir)).select("customerid", "email")
    a = domain.artist(spark, sf_dir).select(F.col("id").alias("artistid"), F.col("name").alias("artist_name"))
    return (best.join(a, "artistid").join(cust, "customerid").join(em, "customerid", "left")
                .select("artistid", "artist_name", "month", "customerid", "customer_name", "email",
                        "week_start", F.col("n").alias("streamCount")))


QUERIES = {
    "top_artists_global": top_artists_global,
    "customers_by_top_artist": customers_by_top_artist,
    "event_near_capacity_alert": event_near_capacity_alert,
    "event_sold_out_alert": event_sold_out_alert,
    "new_event_top_streamer_alert": new_event_top_streamer_alert,
    "new_event_top_streamer_alert_asof": new_event_top_streamer_alert_asof,
    "new_event_top_streamer_email": new_event_top_streamer_email,
    "venue_most_events": venue_most_events,
    "venue_most_customers": venue_most_customers,
    "genre_event_suggestion": genre_event_suggestion,
    "genre_popular_event_suggestion": genre_popular_event_suggestion,
    "total_customers": total_customers,
    "total_streams": total_streams,
    "total_events": total_events,
    "total_tickets": total_tickets,
    "total_past_events": total_past_events,
    "tickets_by_zip": tickets_by_zip,
    "zip_popular_event_alert": zip_popular_event_alert,
    "monthly_top_weekly_streamer": monthly_top_weekly_streamer,
}
