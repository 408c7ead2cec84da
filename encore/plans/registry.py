"""All registered queries: name -> DataFrame builder, and name -> DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from encore.plans import jobs as J
from encore.plans import scenarios as R
from encore.plans import sql as S
from encore.plans import streams as ST
from encore.plans.scenarios_sql import SCENARIO_SQL
from encore.plans.jobs_sql import JOB_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q.update(S.QUERIES)
    q.update(J.QUERIES)
    q.update(R.QUERIES)
    q.update({k: fn for k, (fn, _) in ST.QUERIES.items()})
    return q


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o.update({k: S.oracle(k) for k in S.QUERIES})
    o.update({k: v for k, v in JOB_SQL.items() if k in J.QUERIES})
    o.update({k: v for k, v in SCENARIO_SQL.items() if k in R.QUERIES})
    o.update({k: o[batch] for k, (_, batch) in ST.QUERIES.items() if batch in o})
    o["stream_global_totals"] = "\nUNION ALL\n".join(
        f"({o[k]})" for k in ("total_customers", "total_streams", "total_events", "total_tickets"))
    return o
