"""Music-business views over the driver's TPC-H-like tables.

The mapping (artist = supplier, event = part, ticket = lineitem, listen =
events row, venue = nation, ...) is the project's test-data convention; the
same definitions exist as DuckDB text in ``encore.plans.oracle`` so both
engines see identical rows.

Scale notes:
* nation (25 rows) and region (5 rows) are fixed-size by the TPC-H
  definition, so they are the only tables broadcast explicitly. Every other
  join is left to Catalyst/AQE, which broadcasts only when the measured size is
  under the threshold and otherwise shuffles.
* ``ticket`` looks the customer up in ``orders`` (a lineitem-sized join); jobs
  that do not need ``customerid`` ask for ``with_customer=False`` and skip it.
* The artist count used to derive ``artistid`` is a scalar subquery, evaluated
  once per query, not a driver-side collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.tables import read_table

# Fixed values of the test-data mapping.
TICKET_EPOCH_SECONDS = 1704067200          # 2024-01-01 00:00:00 UTC
TICKET_SPREAD_SECONDS = 2592000            # arrivals spread over 30 days
EVENT_DATE_ORIGIN = "1995-01-01"
EVENT_DATE_SPAN_DAYS = 2500
BIRTH_DATE_ORIGIN = "1985-01-01"
BIRTH_DATE_SPAN_DAYS = 7300
VENUE_COUNT = 25
VENUE_MAX_CAPACITY = 50
LEGACY_KEYS = 1_000_000_000_000            # added to a supplier's key
SHUFFLE_STEP = 4096


def artist_count(spark: SparkSession, sf_dir: str) -> Column:
    """Number of artists, as a scalar subquery (evaluated once per query)."""
    return _artist_count(spark, sf_dir)


def _artist_count(spark: SparkSession, sf_dir: str) -> Column:
    return read_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()


def artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "inner")
             .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                     F.col("n_name").alias("genre")))


def event(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    day = F.date_add(F.lit(EVENT_DATE_ORIGIN).cast("date"),
                     ((F.col("p_partkey") * 37) % EVENT_DATE_SPAN_DAYS).cast("int"))
    return p.select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") % _artist_count(spark, sf_dir)).alias("artistid"),
        (F.col("p_partkey") % VENUE_COUNT).alias("venueid"),
        F.col("p_size").alias("capacity"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00:00.000")).alias("eventdate"),
    )


def venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_nationkey").cast("bigint").alias("addressid"),
        F.col("n_name").alias("name"),
        F.lit(VENUE_MAX_CAPACITY).alias("maxcapacity"),
    )


def ticket_arrival(orderkey: Column, linenumber: Column, partkey: Column) -> Column:
    offset = (orderkey * 1999 + linenumber * 7919 + partkey * 31) % TICKET_SPREAD_SECONDS
    return F.timestamp_seconds(F.lit(TICKET_EPOCH_SECONDS) + offset)


def ticket(spark: SparkSession, sf_dir: str, with_customer: bool = True) -> DataFrame:
    """Tickets in arrival order ``(arrival, id, price)``, unique at every scale.

    ``customerid`` comes from ``orders`` by a left join (a ticket whose order is
    missing keeps a null customer); ``with_customer=False`` leaves it out.
    """
    orders = read_table(spark, sf_dir, "orders") if with_customer else None
    return ticket_from(read_table(spark, sf_dir, "lineitem"), orders)


def ticket_from(lineitem: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """The ticket projection of ``lineitem`` rows (static or streaming); with
    ``orders`` (a static table), the customer is looked up by a left join."""
    li = lineitem
    cols = [
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_partkey").alias("eventid"),
        F.col("l_extendedprice").alias("price"),
        ticket_arrival(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("arrival"),
    ]
    if orders is None:
        return li.select(*cols)
    o = orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    return j.select(cols[0], F.col("o_custkey").alias("customerid"), *cols[1:])


def listen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens (the model's ``stream`` entity).

    ``pos`` is the record's arrival sequence number: the events table's
    ``event_id``, along which ``ts`` never decreases, so arrival order equals
    ``(streamtime, id)`` order. A single bigint keeps every first/last-position
    aggregate a hash aggregate.
    """
    return listen_from(read_table(spark, sf_dir, "events"), _artist_count(spark, sf_dir))


def listen_from(events: DataFrame, artist_count: Column) -> DataFrame:
    """The listen projection of ``events`` rows (static or streaming)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customerid"),
        (k % artist_count).alias("artistid"),
        F.col("ts").alias("streamtime"),
        F.col("event_id").alias("pos"),
    )


def _birthdt() -> Column:
    day = F.date_add(F.lit(BIRTH_DATE_ORIGIN).cast("date"),
                     ((F.col("c_custkey") * 37) % BIRTH_DATE_SPAN_DAYS).cast("int"))
    return F.date_format(day, "yyyy-MM-dd")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_from(read_table(spark, sf_dir, "customer"))


def customer_from(c: DataFrame) -> DataFrame:
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("type"),
        F.col("c_name").alias("fullname"),
        _birthdt().alias("birthdt"),
    )


def customer_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers on the legacy topic: the suppliers, with keys of their own."""
    return customer_legacy_from(read_table(spark, sf_dir, "supplier"))


def customer_legacy_from(s: DataFrame) -> DataFrame:
    return customer_from(s.select((F.col("s_suppkey") + LEGACY_KEYS).alias("c_custkey"), F.lit("LEGACY").alias("c_mktsegment"),
                                  F.col("s_name").alias("c_name")))


def one_per_customer(rows: DataFrame) -> DataFrame:
    """A customer's row with the smallest id, for tables that may hold several (addresses, emails)."""
    first = F.min_by(F.struct(*[c for c in rows.columns if c != "customerid"]), "id").alias("row")
    return rows.where("customerid is not null").groupBy("customerid").agg(first).select("customerid", "row.*")


def event_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When every event was announced, ``id, artistid, created``: spread over the thirty days of the listens."""
    e = event(spark, sf_dir)
    at = F.lit(TICKET_EPOCH_SECONDS) + (F.col("id") * 7817) % (30 * 86400)
    return e.select("id", "artistid", F.timestamp_seconds(at).alias("created"))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a changelog ``id, capacity, updated``: every event appears some days into the sale, a third
    of them change their capacity later, some are deleted (a null capacity) and half of those come back."""
    p = read_table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")

    def change(day: int, capacity: Column, where: Column) -> Column:
        at = F.timestamp_seconds(F.lit(TICKET_EPOCH_SECONDS) + day * 86400 + (key * 613) % 86400)
        return F.when(where, F.struct(capacity.cast("bigint").alias("capacity"), at.alias("updated")))

    changes = F.array(change(2, size, F.lit(True)), change(8, size + key % 7, key % 3 == 0),
                      change(15, F.lit(None), key % 11 == 0), change(20, size + 1, key % 22 == 0))
    return p.select(key.alias("id"), F.explode(F.array_compact(changes)).alias("c")).select("id", "c.capacity", "c.updated")


def listen_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens that arrive up to 3,000 places late; ``pos`` is unique, in steps of ``SHUFFLE_STEP``."""
    listens = listen(spark, sf_dir)
    late = F.col("id") + (F.col("id") * 7919) % 3000
    return listens.withColumn("pos", late * SHUFFLE_STEP + F.col("id") % SHUFFLE_STEP)


def listen_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens from two source partitions, of which the second is up to 3,000 places late and the first up to 300;
    ``pos`` is unique, in steps of ``SHUFFLE_STEP``."""
    part = F.col("id") % 2
    late = F.col("id") + (F.col("id") * 7919) % F.when(part == 1, 3000).otherwise(300)
    listens = listen(spark, sf_dir).withColumn("partition", part.cast("int"))
    return listens.withColumn("pos", late * SHUFFLE_STEP + F.col("id") % SHUFFLE_STEP)


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address_from(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"),
                        read_table(spark, sf_dir, "region"))


def address_from(c: DataFrame, n: DataFrame, r: DataFrame) -> DataFrame:
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "inner")
    j = c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey, "inner")
    return j.select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("customerid"),
        F.col("c_name").alias("line1"),
        F.col("c_mktsegment").alias("line2"),
        F.col("n_name").alias("citynm"),
        F.col("r_name").alias("state"),
        F.lpad((F.col("c_custkey") % 100).cast("string"), 5, "0").alias("zip5"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("zip4"),
        F.lit("USA").alias("countrycd"),
    )


def email(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("customerid"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("@email.com")).alias("email"),
    )


VIEWS = {
    "artist": artist,
    "event": event,
    "venue": venue,
    "ticket": ticket,
    "listen": listen,
    "patron": customer,
    "address": address,
    "email": email,
}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register the domain views as temp views for ``spark.sql`` text queries."""
    for name, fn in VIEWS.items():
        fn(spark, sf_dir).createOrReplaceTempView(name)
