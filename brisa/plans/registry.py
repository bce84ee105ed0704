"""The list of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def flat(df: DataFrame) -> DataFrame:
    """Primary pollutants as text, for results that are compared as tables."""
    return df.withColumn("primary_pollutants", F.concat_ws(",", "primary_pollutants"))
