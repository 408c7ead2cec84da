"""Predicate routing (``split().branch(...)``): first matching branch wins,
rows matching no branch are dropped. One projection, no extra scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_column(branches: list[tuple[str, Column]], default: str | None = None) -> Column:
    expr = None
    for name, pred in branches:
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def route(df: DataFrame, branches: list[tuple[str, Column]], default: str | None = None,
          out: str = "route") -> DataFrame:
    """Tag each row with its branch name; rows with no branch are dropped."""
    return df.withColumn(out, route_column(branches, default)).where(F.col(out).isNotNull())


def split(df: DataFrame, branches: list[tuple[str, Column]], default: str | None = None,
          out: str = "route") -> dict[str, DataFrame]:
    """One DataFrame per branch (for sinks that differ). Persist ``df`` first
    if it is expensive; each branch is a filter over the routed rows."""
    routed = route(df, branches, default, out)
    names = [n for n, _ in branches] + ([default] if default else [])
    return {n: routed.where(F.col(out) == n).drop(out) for n in names}
