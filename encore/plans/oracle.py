"""DuckDB text of the domain views, for the SQL oracle.

Each entry is the same row set as the function of the same name in
``encore.sources.domain``. ``with_views`` prefixes a query with the views it
names, so each oracle string runs on the bare base tables.
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "artist": "SELECT s_suppkey AS id, s_name AS name, n_name AS genre "
              "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "event": "SELECT p_partkey AS id, p_partkey % (SELECT count(*) FROM supplier) AS artistid, "
             "p_partkey % 25 AS venueid, p_size AS capacity, "
             "strftime(DATE '1995-01-01' + CAST((p_partkey * 37) % 2500 AS INTEGER), '%Y-%m-%d') "
             "|| ' 00:00:00.000' AS eventdate FROM part",
    "venue": "SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_nationkey AS BIGINT) AS addressid, "
             "n_name AS name, 50 AS maxcapacity FROM nation",
    "ticket": "SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, "
              "o_custkey AS customerid, l_partkey AS eventid, l_extendedprice AS price, "
              "TIMESTAMP '2024-01-01 00:00:00' + to_seconds((l_orderkey * 1999 + l_linenumber * 7919 "
              "+ l_partkey * 31) % 2592000) AS arrival "
              "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
    "listen": "SELECT event_id AS id, user_id AS customerid, "
              "CAST(props->>'k' AS BIGINT) % (SELECT count(*) FROM supplier) AS artistid, "
              "ts AS streamtime, event_id AS pos FROM events",
    "patron": "SELECT c_custkey AS id, c_mktsegment AS type, c_name AS fullname, "
              "strftime(DATE '1985-01-01' + CAST((c_custkey * 37) % 7300 AS INTEGER), '%Y-%m-%d') AS birthdt "
              "FROM customer",
    "address": "SELECT c_custkey AS id, c_custkey AS customerid, c_name AS line1, c_mktsegment AS line2, "
               "n_name AS citynm, r_name AS state, lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0') AS zip5, "
               "lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS zip4, 'USA' AS countrycd "
               "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "email": "SELECT c_custkey AS id, c_custkey AS customerid, CAST(c_custkey AS VARCHAR) || '@email.com' AS email "
             "FROM customer",
}


def with_views(sql: str, extra_ctes: str = "") -> str:
    """Prefix ``sql`` with CTEs for every domain view it mentions.

    ``extra_ctes`` (``name AS (...), ...``) are appended after the views, so a
    query can define its own steps on top of them.
    """
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql + " " + extra_ctes)]
    ctes = [f"{v} AS ({VIEW_SQL[v]})" for v in used]
    if extra_ctes:
        ctes.append(extra_ctes)
    if not ctes:
        return sql
    return "WITH " + ",\n".join(ctes) + "\n" + sql
