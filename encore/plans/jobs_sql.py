"""DuckDB oracle text for the P-jobs (window-function forms, run at small scale).

Positions are materialised with a global ``row_number()`` here, which is fine
for an oracle on one machine; the Spark plans never sort globally.
"""

from __future__ import annotations

from encore.plans.oracle import with_views

LISTEN_POS = "row_number() OVER (ORDER BY streamtime, id)"
WEEK = 604800

_P5_COUNTS = """
lp AS (SELECT *, {pos} AS pos,
              max(streamtime) OVER (ORDER BY streamtime, id ROWS UNBOUNDED PRECEDING) AS stream_time
       FROM listen),
kept AS (SELECT * FROM lp
         WHERE make_timestamp(CAST(floor(epoch_us(streamtime) / {w_us}) AS BIGINT) * {w_us}) + to_seconds({w})
               > stream_time - to_seconds(1)),
wc AS (SELECT artistid, customerid,
              make_timestamp(CAST(floor(epoch_us(streamtime) / {w_us}) AS BIGINT) * {w_us}) AS window_start,
              count(*) AS n, max(pos) AS last_pos
       FROM kept WHERE artistid IS NOT NULL AND customerid IS NOT NULL GROUP BY ALL)"""


def _p5_counts(w: int) -> str:
    return _P5_COUNTS.format(pos=LISTEN_POS, w=w, w_us=w * 1_000_000)


P2_BODY = """
a AS (SELECT t.*, e.capacity FROM ticket t JOIN event e ON t.eventid = e.id),
nn AS (SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY arrival, id, price) AS n FROM a),
conf AS (SELECT eventid, id AS ticket_id, customerid, price, arrival, n AS request_no,
       CAST(capacity - n AS DOUBLE) AS remainingTickets,
       CASE WHEN capacity - n < 0 THEN 'REJECTED' ELSE 'CONFIRMED' END AS confirmationStatus,
       CASE WHEN capacity - n < 0 THEN 'NONE' WHEN capacity - n = 0 THEN 'SOLD_OUT_NOW'
            WHEN CAST(capacity - n AS DOUBLE) / capacity * 100 <= 20 THEN 'LIMITED' ELSE 'AVAILABLE' END AS availability,
       sha256(concat_ws('|', id, eventid, n)) AS confirmationId
FROM nn)"""

P3_BODY = """
ev AS (SELECT customerid, artistid, streamtime AS time, 0 AS side, id AS lid, CAST(NULL AS VARCHAR) AS tid FROM listen
       UNION ALL
       SELECT t.customerid, e.artistid, t.arrival, 1, CAST(NULL AS BIGINT), t.id FROM ticket t JOIN event e ON t.eventid = e.id),
e2 AS (SELECT *, row_number() OVER (ORDER BY time, side, lid, tid) AS pos FROM ev WHERE customerid IS NOT NULL),
f AS (SELECT customerid, artistid, min(CASE WHEN side = 0 THEN pos END) AS l, min(CASE WHEN side = 1 THEN pos END) AS p
      FROM e2 GROUP BY customerid, artistid),
m AS (SELECT customerid, min(greatest(l, p)) AS first_match FROM f WHERE l IS NOT NULL AND p IS NOT NULL GROUP BY customerid),
hit AS (SELECT e2.* FROM e2 JOIN m USING (customerid) WHERE pos >= first_match)"""

P4_BODY = """
r AS (SELECT t.id, t.price, t.arrival, e.artistid, CAST(trunc(t.price) AS BIGINT) AS rev
      FROM ticket t JOIN event e ON t.eventid = e.id),
tot AS (SELECT *, CAST(sum(rev) OVER (PARTITION BY artistid ORDER BY arrival, id, price ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
        FROM r),
rep AS (SELECT tot.*, a.name AS artist_name, a.genre AS artist_genre FROM tot JOIN artist a ON tot.artistid = a.id),
pm AS (SELECT *, max(total) OVER (ORDER BY arrival, id, price ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
       FROM rep),
rec AS (SELECT *, CASE WHEN prev_max IS NULL OR total > prev_max
                       THEN struct_pack(a := artistid, nm := artist_name, g := artist_genre, v := total) END AS recd FROM pm),
led AS (SELECT *, last_value(recd IGNORE NULLS) OVER (ORDER BY arrival, id, price ROWS UNBOUNDED PRECEDING) AS leader
        FROM rec)"""

AS_OF_BODY = """
changes AS (SELECT p_partkey AS id, CAST(cap AS BIGINT) AS capacity,
                   TIMESTAMP '2024-01-01 00:00:00' + to_seconds(day * 86400 + (p_partkey * 613) % 86400) AS updated
            FROM (SELECT p_partkey, 2 AS day, p_size AS cap FROM part
                  UNION ALL SELECT p_partkey, 8, p_size + p_partkey % 7 FROM part WHERE p_partkey % 3 = 0
                  UNION ALL SELECT p_partkey, 15, NULL FROM part WHERE p_partkey % 11 = 0
                  UNION ALL SELECT p_partkey, 20, p_size + 1 FROM part WHERE p_partkey % 22 = 0) AS c),
seen AS (SELECT t.*, c.capacity FROM ticket t ASOF JOIN changes c ON c.id = t.eventid AND c.updated <= t.arrival
         WHERE c.capacity IS NOT NULL)"""

LATE_BODY = """
shuffled AS (SELECT *, row_number() OVER (ORDER BY id + (id * 7919) % 3000, id % 4096) AS place FROM listen),
clock AS (SELECT *, date_trunc('day', streamtime) AS day, max(streamtime) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) AS now
          FROM shuffled),
timely AS (SELECT * FROM clock WHERE day + INTERVAL 1 DAY > now - INTERVAL 1 SECOND)"""

ADDRESS_TEXT = ("coalesce(line1, '') || ', ' || coalesce(line2, '') || ', ' || coalesce(citynm, '') || ', ' || "
                "coalesce(state, '') || ' ' || coalesce(zip5, '') || '-' || coalesce(zip4, '') || ' ' || "
                "coalesce(countrycd, '')")

TARGET = ("try_strptime(birthdt, '%Y-%m-%d')::DATE BETWEEN DATE '1990-01-01' AND DATE '1999-12-31'")


def _q(body: str, select: str) -> str:
    return with_views(select, extra_ctes=body.strip())


def _job_sql() -> dict[str, str]:
    q = {}
    q["top_customer_artists"] = with_views(
        'SELECT customerid, rk AS "rank", artistid, n FROM r WHERE rk <= 3',
        extra_ctes=f"""l AS (SELECT customerid, artistid, {LISTEN_POS} AS pos FROM listen WHERE customerid IS NOT NULL),
g AS (SELECT customerid, artistid, count(*) AS n, min(pos) AS f, max(pos) AS lp FROM l GROUP BY customerid, artistid),
r AS (SELECT *, row_number() OVER (PARTITION BY customerid ORDER BY n DESC, lp) AS rk FROM g)""")
    # By definition: for every listen, the artists of all listens up to it.
    q["top_customer_artists_changelog"] = with_views("""
SELECT customerid, listen_id, max(CASE WHEN rk = 1 THEN artistid END) AS artist1, max(CASE WHEN rk = 1 THEN n END) AS n1,
       max(CASE WHEN rk = 2 THEN artistid END) AS artist2, max(CASE WHEN rk = 2 THEN n END) AS n2,
       max(CASE WHEN rk = 3 THEN artistid END) AS artist3, max(CASE WHEN rk = 3 THEN n END) AS n3
FROM ranked GROUP BY customerid, listen_id""", extra_ctes="""
upto AS (SELECT b.customerid, b.id AS listen_id, a.artistid, count(*) AS n, max(a.pos) AS lp
         FROM listen b JOIN listen a ON a.customerid = b.customerid AND a.pos <= b.pos GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customerid, listen_id ORDER BY n DESC, lp) AS rk FROM upto)""")
    # By definition: the artists of all listens up to each listen.
    q["artist_rank_changelog"] = with_views("""
SELECT r.customerid, r.listen_id, r.artistid, r.n, r.rk AS "rank", r.artists
FROM ranked r JOIN listen l ON l.id = r.listen_id AND l.artistid IS NOT DISTINCT FROM r.artistid""", extra_ctes="""
upto AS (SELECT b.customerid, b.id AS listen_id, a.artistid, count(*) AS n, max(a.pos) AS lp
         FROM listen b JOIN listen a ON a.customerid = b.customerid AND a.pos <= b.pos GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customerid, listen_id ORDER BY n DESC, lp) AS rk,
                  count(*) OVER (PARTITION BY customerid, listen_id) AS artists FROM upto)""")
    q["customer_artist_counters"] = with_views("""
SELECT customerid, artistid, count(*) AS n, CAST(floor(3.5 * sum(count(*)) OVER (PARTITION BY customerid) / 2048) AS BIGINT) AS error
FROM listen WHERE customerid IS NOT NULL AND artistid IS NOT NULL GROUP BY customerid, artistid""")
    q["customer_match_changelog"] = _q(P3_BODY, """
SELECT customerid, time, side, lid, tid, lag(matched) OVER (PARTITION BY customerid ORDER BY pos) AS old_match, matched AS new_match
FROM (SELECT e2.*, coalesce(pos >= first_match, false) AS matched FROM e2 LEFT JOIN m USING (customerid))""")
    q["tickets_as_of"] = _q(AS_OF_BODY, """
SELECT id AS ticket_id, eventid, arrival, price, capacity FROM seen""")
    q["purchase_event_ticket_asof"] = _q(AS_OF_BODY + """,
nn AS (SELECT *, row_number() OVER w AS n, first_value(capacity) OVER w AS cap FROM seen
       WINDOW w AS (PARTITION BY eventid ORDER BY arrival, id, price ROWS UNBOUNDED PRECEDING))""", """
SELECT eventid, id AS ticket_id, customerid, price, arrival, n AS request_no, CAST(cap - n AS DOUBLE) AS remainingTickets,
       CASE WHEN cap < n THEN 'REJECTED' ELSE 'CONFIRMED' END AS confirmationStatus,
       CASE WHEN cap < n THEN 'NONE' WHEN cap = n THEN 'SOLD_OUT_NOW'
            WHEN CAST(cap - n AS DOUBLE) / cap * 100 <= 20 THEN 'LIMITED' ELSE 'AVAILABLE' END AS availability,
       sha256(concat_ws('|', id, eventid, n)) AS confirmationId FROM nn""")
    q["listened_artists"] = with_views("""
SELECT customerid, artistid, min(pos) AS first_pos, row_number() OVER (PARTITION BY customerid ORDER BY min(pos)) AS nth
FROM listen WHERE customerid IS NOT NULL GROUP BY customerid, artistid""")
    q["json_round_trip"] = with_views("SELECT CAST(customerid AS VARCHAR) AS key, * FROM listen")
    q["late_stream_counts"] = _q(LATE_BODY, """
SELECT artistid, customerid, day AS window_start, day + INTERVAL 1 DAY AS window_end, count(*) AS n
FROM timely WHERE artistid IS NOT NULL AND customerid IS NOT NULL GROUP BY ALL""")
    q["partition_late_stream_counts"] = _q("""
dealt AS (SELECT *, row_number() OVER (ORDER BY id + (id * 7919) % (CASE WHEN id % 2 = 1 THEN 3000 ELSE 300 END), id % 4096) AS place
          FROM listen WHERE artistid IS NOT NULL AND customerid IS NOT NULL),
clock AS (SELECT *, date_trunc('day', streamtime) AS day,
                 max(streamtime) OVER (PARTITION BY id % 2 ORDER BY place ROWS UNBOUNDED PRECEDING) AS now FROM dealt)""", """
SELECT artistid, customerid, day AS window_start, day + INTERVAL 1 DAY AS window_end, count(*) AS n
FROM clock WHERE day + INTERVAL 1 DAY > now - INTERVAL 1 SECOND GROUP BY ALL""")
    q["thank_you_top_streamer_changelog"] = _q("""
counted AS (SELECT artistid, customerid, pos, count(*) OVER (PARTITION BY artistid, customerid, date_trunc('day', streamtime)
                                                             ORDER BY pos ROWS UNBOUNDED PRECEDING) AS n
            FROM listen WHERE artistid IS NOT NULL AND customerid IS NOT NULL),
best AS (SELECT artistid, pos, max({'n': n, 'at': -pos, 'who': customerid})
                OVER (PARTITION BY artistid ORDER BY pos ROWS UNBOUNDED PRECEDING) AS b FROM counted)""", """
SELECT pos, b.who AS customerId, CAST(b.who AS VARCHAR) AS customerName, artistid AS artistId, '' AS artistName, '' AS email,
       b.n AS streamCount
FROM best WHERE artistid IN (SELECT id FROM artist) AND b.who IN (SELECT id FROM patron)""")
    q["purchase_event_ticket"] = _q(P2_BODY, "SELECT * FROM conf")
    q["ticket_confirmation_notices"] = _q(P2_BODY, """
SELECT confirmationId, 'tickets@example.com' AS sender, CAST(customerid AS VARCHAR) || '@email.com' AS recipient,
       'Ticket Confirmation (' || confirmationId || ') - Event ' || CAST(eventid AS VARCHAR) AS subject,
       'Your ticket has been ' || confirmationStatus || '!' AS body
FROM conf""")
    q["customer_conversion_tally"] = _q(P3_BODY, "SELECT 'TALLY' AS key, count(*) AS value FROM hit")
    q["customer_conversion_tally_changelog"] = _q(P3_BODY, """
SELECT 'TALLY' AS key, customerid, time, side, lid, tid,
       count(*) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS value FROM hit""")
    q["artist_revenue"] = with_views("""
SELECT e.artistid, CAST(sum(CAST(trunc(t.price) AS BIGINT)) AS BIGINT) AS revenue
FROM ticket t JOIN event e ON t.eventid = e.id GROUP BY e.artistid""")
    q["artist_revenue_leader_changelog"] = _q(P4_BODY, """
SELECT 'global' AS key, id AS ticket_id, arrival, price, leader.a AS artistId, leader.nm AS artist_name,
       leader.g AS artist_genre, leader.v AS revenue FROM led""")
    q["artist_revenue_leader"] = _q(P4_BODY, """
SELECT 'global' AS key, leader.a AS artistId, leader.nm AS artist_name, leader.g AS artist_genre, leader.v AS revenue
FROM led ORDER BY arrival DESC, id DESC, price DESC LIMIT 1""")
    w = 86400
    q["windowed_stream_counts"] = _q(_p5_counts(w), f"""
SELECT artistid, customerid, window_start, window_start + to_seconds({w}) AS window_end, n FROM wc""")
    q["thank_you_top_streamer"] = _q(_p5_counts(w) + """,
best AS (SELECT *, row_number() OVER (PARTITION BY artistid ORDER BY n DESC, last_pos) AS rk FROM wc)""", """
SELECT customerid AS customerId, CAST(customerid AS VARCHAR) AS customerName, artistid AS artistId,
       '' AS artistName, '' AS email, n AS streamCount
FROM best WHERE rk = 1 AND artistid IN (SELECT id FROM artist) AND customerid IN (SELECT id FROM patron)""")
    q["target_customer_filter"] = with_views(f"SELECT * FROM patron WHERE {TARGET}")
    q["target_customer_filter_merged"] = with_views(f"""
SELECT * FROM (SELECT * FROM patron UNION ALL
               SELECT s_suppkey + 1000000000000, 'LEGACY', s_name,
                      strftime(DATE '1985-01-01' + CAST(((s_suppkey + 1000000000000) * 37) % 7300 AS INTEGER), '%Y-%m-%d')
               FROM supplier) u
WHERE {TARGET}""")
    q["address_by_state"] = with_views(f"SELECT state AS key, {ADDRESS_TEXT} AS value FROM address")
    q["address_split_priority"] = with_views(f"""
SELECT state AS key, {ADDRESS_TEXT} AS value, CASE WHEN state = 'ASIA' THEN 'priority' ELSE 'default' END AS sink
FROM address""")
    q["customer_stream_count"] = with_views(
        "SELECT customerid, count(*) AS n FROM listen WHERE customerid IS NOT NULL GROUP BY customerid")
    q["customer_stream_count_changelog"] = with_views("""
SELECT customerid, id AS listen_id, streamtime,
       count(*) OVER (PARTITION BY customerid ORDER BY streamtime, id ROWS UNBOUNDED PRECEDING) AS n
FROM listen WHERE customerid IS NOT NULL""")
    q["artist_ticket_count"] = with_views("""
SELECT e.artistid, count(*) AS n FROM ticket t JOIN event e ON t.eventid = e.id
WHERE e.artistid IS NOT NULL GROUP BY e.artistid""")
    q["artist_ticket_count_changelog"] = with_views("""
SELECT e.artistid, t.id AS ticket_id, t.arrival,
       count(*) OVER (PARTITION BY e.artistid ORDER BY t.arrival, t.id, t.price ROWS UNBOUNDED PRECEDING) AS n
FROM ticket t JOIN event e ON t.eventid = e.id WHERE e.artistid IS NOT NULL""")
    q["passthrough"] = with_views("SELECT * FROM listen")
    return q


JOB_SQL = _job_sql()
