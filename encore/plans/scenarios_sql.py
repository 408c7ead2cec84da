"""DuckDB oracle text for the R-scenarios."""

from __future__ import annotations

from encore.plans.jobs_sql import LISTEN_POS
from encore.plans.oracle import with_views

AS_OF = "1999-01-01 00:00:00"

_SEQ = """
ta AS (SELECT t.id, t.arrival, t.price, e.id AS eventid, e.artistid, e.capacity
       FROM ticket t JOIN event e ON t.eventid = e.id),
seq AS (SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY arrival, id, price) AS sold FROM ta),
near AS (SELECT eventid, artistid, id AS ticket_id, arrival, sold, capacity FROM seq WHERE sold = (capacity * 9 + 9) // 10)"""

_P1_TOP1 = f"""
l1 AS (SELECT customerid, artistid, {LISTEN_POS} AS pos FROM listen WHERE customerid IS NOT NULL),
g1 AS (SELECT customerid, artistid, count(*) AS n, min(pos) AS f, max(pos) AS lp FROM l1 GROUP BY customerid, artistid),
r1 AS (SELECT *, row_number() OVER (PARTITION BY customerid ORDER BY n DESC, lp) AS rk FROM g1)"""

_STREAMERS = f"""
l2 AS (SELECT customerid, artistid, {LISTEN_POS} AS pos FROM listen),
g2 AS (SELECT customerid, artistid, count(*) AS n, max(pos) AS lp FROM l2
       WHERE customerid IS NOT NULL AND artistid IS NOT NULL GROUP BY customerid, artistid),
r2 AS (SELECT *, row_number() OVER (PARTITION BY artistid ORDER BY n DESC, lp) AS rk FROM g2)"""

_GENRE = f"""
l3 AS (SELECT customerid, artistid, {LISTEN_POS} AS pos FROM listen),
g3 AS (SELECT l3.customerid, a.genre, count(*) AS n, max(pos) AS lp FROM l3 JOIN artist a ON l3.artistid = a.id
       WHERE l3.customerid IS NOT NULL GROUP BY l3.customerid, a.genre),
top3 AS (SELECT *, row_number() OVER (PARTITION BY customerid ORDER BY n DESC, lp) AS rk FROM g3),
aud AS (SELECT genre, count(*) AS audience FROM top3 WHERE rk = 1 GROUP BY genre)"""


def _q(body: str, select: str) -> str:
    return with_views(select, extra_ctes=body.strip())


def _scenario_sql() -> dict[str, str]:
    q = {}
    q["top_artists_global"] = with_views("""
SELECT artistid, count(*) AS n FROM listen WHERE artistid IS NOT NULL GROUP BY artistid ORDER BY n DESC, artistid LIMIT 3""")
    q["customers_by_top_artist"] = _q(_P1_TOP1, """
SELECT artistid, customerid, count(*) OVER (PARTITION BY artistid) AS group_size FROM r1 WHERE rk = 1""")
    q["event_near_capacity_alert"] = _q(_SEQ, "SELECT * FROM near")
    q["event_sold_out_alert"] = _q(_SEQ, """
SELECT eventid, artistid, id AS ticket_id, arrival, sold, capacity FROM seq WHERE sold = capacity""")
    q["new_event_top_streamer_alert"] = _q(_STREAMERS, """
SELECT e.id AS eventid, e.artistid, r2.customerid, r2.rk AS "rank", r2.n FROM event e JOIN r2 ON e.artistid = r2.artistid
WHERE r2.rk <= 3""")
    q["new_event_top_streamer_alert_asof"] = _q("""
announced AS (SELECT id AS eventid, artistid, TIMESTAMP '2024-01-01 00:00:00' + to_seconds((id * 7817) % 2592000) AS created FROM event),
heard AS (SELECT eventid, a.artistid, l.customerid, count(*) AS n, max(l.pos) AS last_pos
          FROM announced a JOIN listen l ON l.artistid = a.artistid AND l.streamtime < a.created
          WHERE l.customerid IS NOT NULL GROUP BY ALL)""", """
SELECT eventid, artistid, customerid, "rank", n
FROM (SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY n DESC, last_pos) AS "rank" FROM heard) WHERE "rank" <= 3""")
    q["new_event_top_streamer_email"] = _q(_STREAMERS, """
SELECT e.id AS eventid, e.artistid, r2.customerid, r2.rk AS "rank", r2.n, em.email
FROM event e JOIN r2 ON e.artistid = r2.artistid LEFT JOIN email em ON em.customerid = r2.customerid
WHERE r2.rk <= 3""")
    q["venue_most_events"] = _q(
        "pv AS (SELECT venueid, count(*) AS events FROM event WHERE venueid IS NOT NULL GROUP BY venueid)", """
SELECT pv.venueid, v.name AS venue_name, pv.events FROM pv LEFT JOIN venue v ON v.id = pv.venueid
ORDER BY events DESC, venueid LIMIT 1""")
    q["venue_most_customers"] = _q("""
pairs AS (SELECT DISTINCT e.venueid, t.customerid FROM ticket t JOIN event e ON t.eventid = e.id
          WHERE t.customerid IS NOT NULL),
pv AS (SELECT venueid, count(*) AS customers FROM pairs GROUP BY venueid)""", """
SELECT pv.venueid, v.name AS venue_name, pv.customers FROM pv LEFT JOIN venue v ON v.id = pv.venueid
ORDER BY customers DESC, venueid LIMIT 1""")
    q["genre_event_suggestion"] = _q(_GENRE, """
SELECT e.id AS eventid, e.artistid, a.genre, aud.audience
FROM event e JOIN artist a ON e.artistid = a.id JOIN aud ON aud.genre = a.genre""")
    q["genre_popular_event_suggestion"] = _q(_SEQ + "," + _GENRE, """
SELECT near.eventid, near.artistid, a.genre, aud.audience
FROM near JOIN artist a ON near.artistid = a.id JOIN aud ON aud.genre = a.genre""")
    q["total_customers"] = with_views("SELECT 'customers' AS metric, count(*) AS total FROM patron")
    q["total_streams"] = with_views("SELECT 'streams' AS metric, count(*) AS total FROM listen")
    q["total_events"] = with_views("SELECT 'events' AS metric, count(*) AS total FROM event")
    q["total_tickets"] = with_views("SELECT 'tickets' AS metric, count(*) AS total FROM ticket")
    q["total_past_events"] = with_views(f"""
SELECT 'past_events' AS metric, count(*) AS total FROM event
WHERE try_strptime(eventdate, '%Y-%m-%d %H:%M:%S.%g') < TIMESTAMP '{AS_OF}'""")
    q["tickets_by_zip"] = with_views("""
SELECT a.zip5, count(*) AS tickets FROM ticket t JOIN address a ON t.customerid = a.customerid GROUP BY a.zip5""")
    q["zip_popular_event_alert"] = _q(_SEQ + """,
b AS (SELECT DISTINCT t.customerid, t.eventid FROM ticket t
      WHERE t.customerid IS NOT NULL AND t.eventid IN (SELECT eventid FROM near)),
buyers AS (SELECT a.zip5, b.eventid, count(*) AS buyers FROM b JOIN address a ON a.customerid = b.customerid
           GROUP BY a.zip5, b.eventid),
residents AS (SELECT zip5, count(*) AS residents FROM address GROUP BY zip5)""", """
SELECT buyers.zip5, eventid, buyers, residents, residents - buyers AS audience
FROM buyers JOIN residents ON buyers.zip5 = residents.zip5""")
    q["monthly_top_weekly_streamer"] = _q(f"""
l4 AS (SELECT customerid, artistid, date_trunc('week', streamtime) AS week_start, {LISTEN_POS} AS pos FROM listen),
c4 AS (SELECT artistid, customerid, week_start, date_trunc('month', week_start) AS month, count(*) AS n, max(pos) AS lp
       FROM l4 WHERE customerid IS NOT NULL AND artistid IS NOT NULL GROUP BY artistid, customerid, week_start),
b4 AS (SELECT *, row_number() OVER (PARTITION BY artistid, month ORDER BY n DESC, lp) AS rk FROM c4)""", """
SELECT b4.artistid, a.name AS artist_name, b4.month, b4.customerid, p.fullname AS customer_name, em.email,
       b4.week_start, b4.n AS streamCount
FROM b4 JOIN artist a ON a.id = b4.artistid JOIN patron p ON p.id = b4.customerid
LEFT JOIN email em ON em.customerid = b4.customerid
WHERE b4.rk = 1""")
    return q


SCENARIO_SQL = _scenario_sql()
