"""The ad-hoc analytical SQL queries over tickets, events, artists and listens.

Each query exists twice: a DataFrame plan written for scale (the one
``queries()`` runs) and the SQL text (``SQL``), which runs unchanged in
``spark.sql`` over the temp views of ``encore.sources.domain.register_views``
and, prefixed with the view CTEs, in DuckDB as the oracle.

Scale choices, shared by all six:
* tickets are aggregated by ``eventid`` *before* joining events (eager
  aggregation), so the big join sees one row per event instead of one per
  ticket and a hot event collapses to one row per map task;
* conversion queries tag listens and purchases and group them once by
  ``(customerid, artistid)`` (partial + final aggregation), which replaces
  the listen x ticket fan-out of the text form and its semi join;
* money is summed as exact decimals and the total rounded to cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions import amount, parse_event_time
from encore.plans.oracle import with_views
from encore.sources import domain

TOP_N = 10
DEFAULT_AS_OF = "1999-01-01 00:00:00"


def _revenue_by_event(t: DataFrame) -> DataFrame:
    return t.groupBy("eventid").agg(F.sum(amount("price")).alias("amount"))


def _revenue_by_artist(tickets: DataFrame, events: DataFrame, as_of: str | None = None) -> DataFrame:
    """(artistid, amount) over tickets whose event exists (inner join)."""
    ev = events
    if as_of is not None:
        ev = ev.where(parse_event_time("eventdate") > F.lit(as_of).cast("timestamp"))
    per_event = _revenue_by_event(tickets.select("eventid", "price"))
    j = per_event.join(ev.select(F.col("id").alias("eventid"), "artistid"), "eventid")
    return j.groupBy("artistid").agg(F.sum("amount").alias("amount"))


def _money(c: str = "amount"):
    return F.round(c, 2).cast("double")


def revenue_by_artist_from(tickets: DataFrame, events: DataFrame, artists: DataFrame, limit: int = TOP_N) -> DataFrame:
    r = _revenue_by_artist(tickets, events)
    j = r.join(artists, r.artistid == artists.id)
    return (j.select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"),
                     _money().alias("total_revenue"))
             .orderBy(F.desc("total_revenue"), "artist_id").limit(limit))


def revenue_by_genre_from(tickets: DataFrame, events: DataFrame, artists: DataFrame, limit: int = TOP_N) -> DataFrame:
    r = _revenue_by_artist(tickets, events)
    g = r.join(artists, r.artistid == artists.id).groupBy("genre").agg(F.sum("amount").alias("amount"))
    return (g.select("genre", _money().alias("total_revenue_by_genre"))
             .orderBy(F.desc("total_revenue_by_genre"), "genre").limit(limit))


def revenue_by_artist_future_from(tickets: DataFrame, events: DataFrame, artists: DataFrame,
                                  as_of: str = DEFAULT_AS_OF, limit: int = TOP_N) -> DataFrame:
    r = _revenue_by_artist(tickets, events, as_of=as_of)
    g = (r.join(artists, r.artistid == artists.id).groupBy(F.col("name").alias("artist_name"))
          .agg(F.sum("amount").alias("amount")))
    return (g.select("artist_name", _money().alias("upcoming_revenue"))
             .orderBy(F.desc("upcoming_revenue"), "artist_name").limit(limit))


def total_revenue_by_artist(spark: SparkSession, sf_dir: str, limit: int = TOP_N) -> DataFrame:
    return revenue_by_artist_from(domain.ticket(spark, sf_dir, with_customer=False), domain.event(spark, sf_dir),
                                  domain.artist(spark, sf_dir), limit)


def total_revenue_by_genre(spark: SparkSession, sf_dir: str, limit: int = TOP_N) -> DataFrame:
    return revenue_by_genre_from(domain.ticket(spark, sf_dir, with_customer=False), domain.event(spark, sf_dir),
                                 domain.artist(spark, sf_dir), limit)


def total_revenue_by_artist_future(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF,
                                   limit: int = TOP_N) -> DataFrame:
    """Revenue of events dated after ``as_of`` (the reference compares with NOW();
    a fixed instant keeps results reproducible), grouped by artist name."""
    return revenue_by_artist_future_from(domain.ticket(spark, sf_dir, with_customer=False),
                                         domain.event(spark, sf_dir), domain.artist(spark, sf_dir), as_of, limit)


def conversion_pairs_from(listens: DataFrame, tickets: DataFrame, events: DataFrame) -> DataFrame:
    """One row per (customer, artist) seen in listens or purchases, with
    ``listened`` / ``purchased`` flags: a tagged union and one grouping (partial
    aggregation before the single shuffle). A purchase can only match a listen
    on non-null keys, so purchases with a null key are left out."""
    l = listens.select("customerid", "artistid", F.lit(1).alias("l"), F.lit(0).alias("p"))
    e = events.select(F.col("id").alias("eventid"), "artistid")
    p = (tickets.select("customerid", "eventid").join(e, "eventid")
                .where(F.col("customerid").isNotNull() & F.col("artistid").isNotNull())
                .select("customerid", "artistid", F.lit(0).alias("l"), F.lit(1).alias("p")))
    return (l.unionByName(p).groupBy("customerid", "artistid")
             .agg((F.max("l") == 1).alias("listened"), (F.max("p") == 1).alias("purchased")))


def conversion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion_pairs_from(domain.listen(spark, sf_dir), domain.ticket(spark, sf_dir),
                                 domain.event(spark, sf_dir))


def _per_customer(pairs: DataFrame) -> DataFrame:
    """Per listening customer: converted iff some artist is both listened and purchased."""
    return (pairs.where(F.col("listened") & F.col("customerid").isNotNull())
                 .groupBy("customerid").agg(F.max(F.col("purchased").cast("int")).alias("converted")))


def conversion_count_from(pairs: DataFrame) -> DataFrame:
    c = _per_customer(pairs)
    return c.agg(F.count(F.when(F.col("converted") == 1, F.lit(1))).alias("conversionCount"))


def conversion_rate_from(pairs: DataFrame) -> DataFrame:
    c = _per_customer(pairs)
    agg = c.agg(F.count(F.when(F.col("converted") == 1, F.lit(1))).alias("n"), F.count(F.lit(1)).alias("listeners"))
    # NULLIF guard: no listeners gives null instead of a division error.
    return agg.select((F.col("n").cast("double") / F.nullif(F.col("listeners"), F.lit(0))).alias("conversionRate"))


def conversion_rate_by_artist_from(pairs: DataFrame, artists: DataFrame) -> DataFrame:
    p = pairs.where(F.col("listened"))
    per_artist = p.groupBy("artistid").agg(
        F.count(F.when(F.col("purchased"), F.col("customerid"))).alias("converted_customers"),
        F.count("customerid").alias("streamed_customers"),
    )
    a = artists.select(F.col("id").alias("artistid"), F.col("name").alias("artist_name"))
    r = per_artist.join(a, "artistid", "left")
    return (r.select("artistid", "artist_name", "converted_customers", "streamed_customers",
                     (F.col("converted_customers").cast("double")
                      / F.nullif(F.col("streamed_customers"), F.lit(0))).alias("conversion_rate"))
             .orderBy(F.desc("conversion_rate"), "artistid"))


def customer_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion_count_from(conversion_pairs(spark, sf_dir))


def customer_conversion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion_rate_from(conversion_pairs(spark, sf_dir))


def conversion_rate_by_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion_rate_by_artist_from(conversion_pairs(spark, sf_dir), domain.artist(spark, sf_dir))


# SQL text, engine-neutral except where noted. Money is summed as decimals
# and rates are doubles so that Spark and DuckDB return identical values.
MONEY_SUM = "CAST(ROUND(SUM(CAST(price AS DECIMAL(18, 6))), 2) AS DOUBLE)"

# Revenue questions start from what each event took in.
_SALES = """
WITH sales AS (SELECT eventid, price FROM ticket),
sold AS (SELECT event.artistid, event.eventdate, sales.price FROM event, sales WHERE sales.eventid = event.id)"""

# Conversion questions start from two sets of (customer, artist): heard and bought.
_PAIRS = """
WITH heard AS (SELECT customerid AS who, artistid AS whom FROM listen GROUP BY 1, 2),
bought AS (SELECT ticket.customerid AS who, event.artistid AS whom FROM ticket, event
           WHERE event.id = ticket.eventid GROUP BY 1, 2),
both_of AS (SELECT heard.who, heard.whom FROM heard, bought WHERE heard.who = bought.who AND heard.whom = bought.whom)"""

SQL = {
    "sql_total_revenue_by_artist": _SALES + f"""
SELECT id AS artist_id, name AS artist_name, total_revenue
FROM (SELECT artistid, {MONEY_SUM} AS total_revenue FROM sold GROUP BY artistid) AS r, artist
WHERE id = artistid
ORDER BY 3 DESC, 1 LIMIT 10""",
    "sql_total_revenue_by_genre": _SALES + f"""
SELECT genre, {MONEY_SUM} AS total_revenue_by_genre
FROM sold, artist WHERE artist.id = sold.artistid
GROUP BY genre ORDER BY 2 DESC, 1 LIMIT 10""",
    "sql_total_revenue_by_artist_future": _SALES + f"""
SELECT name AS artist_name, {MONEY_SUM} AS upcoming_revenue
FROM sold, artist WHERE artist.id = sold.artistid AND {{parse_event}} > TIMESTAMP '{DEFAULT_AS_OF}'
GROUP BY name ORDER BY 2 DESC, 1 LIMIT 10""",
    "sql_customer_conversion": _PAIRS + """
SELECT count(*) AS conversionCount FROM (SELECT who FROM both_of GROUP BY who) AS converts""",
    "sql_customer_conversion_rate": _PAIRS + """,
converts AS (SELECT count(DISTINCT who) AS n FROM both_of),
listeners AS (SELECT count(DISTINCT who) AS n FROM heard)
SELECT CASE WHEN listeners.n > 0 THEN CAST(converts.n AS DOUBLE) / listeners.n END AS conversionRate
FROM converts, listeners""",
    "sql_conversion_rate_by_artist": _PAIRS + """,
audience AS (SELECT whom, count(who) AS n FROM heard GROUP BY whom),
buyers AS (SELECT whom, count(who) AS n FROM both_of GROUP BY whom),
rated AS (SELECT audience.whom AS artistid, coalesce(buyers.n, 0) AS converted_customers, audience.n AS streamed_customers
          FROM audience LEFT JOIN buyers ON buyers.whom = audience.whom)
SELECT artistid, name AS artist_name, converted_customers, streamed_customers,
       CASE WHEN streamed_customers > 0 THEN CAST(converted_customers AS DOUBLE) / streamed_customers END AS conversion_rate
FROM rated LEFT JOIN artist ON artist.id = rated.artistid
ORDER BY 5 DESC, 1""",
}

_PARSE_EVENT = {
    "spark": "try_to_timestamp(eventdate, 'yyyy-MM-dd HH:mm:ss.SSS')",
    "duckdb": "try_strptime(eventdate, '%Y-%m-%d %H:%M:%S.%g')",
}


def sql_text(name: str, dialect: str = "spark") -> str:
    return SQL[name].replace("{parse_event}", _PARSE_EVENT[dialect])


def run_sql(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run the SQL-text form of a query on Spark (views registered first)."""
    domain.register_views(spark, sf_dir)
    return spark.sql(sql_text(name, "spark"))


def oracle(name: str) -> str:
    body, _, select = sql_text(name, "duckdb").strip().removeprefix("WITH ").rpartition(")\nSELECT")
    return with_views("SELECT" + select, extra_ctes=body + ")")


QUERIES = {
    "sql_total_revenue_by_artist": total_revenue_by_artist,
    "sql_total_revenue_by_genre": total_revenue_by_genre,
    "sql_total_revenue_by_artist_future": total_revenue_by_artist_future,
    "sql_customer_conversion": customer_conversion,
    "sql_customer_conversion_rate": customer_conversion_rate,
    "sql_conversion_rate_by_artist": conversion_rate_by_artist,
}
