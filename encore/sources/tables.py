"""Readers for the base parquet tables.

Every reader returns a lazy DataFrame; Catalyst prunes the columns a query
does not use and pushes its filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in BASE_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Schemas read from the parquet footers, once per table per session (like a
# catalog entry); later reads skip the footer inference.
_SCHEMAS: dict[tuple[int, str], object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = table_path(sf_dir, name)
    key = (id(spark), path)
    sch = _SCHEMAS.get(key)
    if sch is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(sch).parquet(path)
