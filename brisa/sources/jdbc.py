"""Database tables through Spark's JDBC source.

Connections are parameters; nothing about any server is known here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)


def read_table(spark: SparkSession, db: Database, table: str) -> DataFrame:
    """A whole table; filters, columns and simple aggregates are pushed to the server."""
    return spark.read.jdbc(db.url, table, properties=dict(db.properties))


def read_query(spark: SparkSession, db: Database, query: str) -> DataFrame:
    """The result of a query that the server runs."""
    return spark.read.jdbc(db.url, f"({query}) t", properties=dict(db.properties))


def read_split(
    spark: SparkSession, db: Database, table: str, predicates: Sequence[str]
) -> DataFrame:
    """One scan partition per predicate; together they must cover every row once."""
    return spark.read.jdbc(
        db.url, table, predicates=list(predicates), properties=dict(db.properties)
    )


def equal_predicates(column: str, values: Sequence[float]) -> list[str]:
    """One predicate per listed value, e.g. per forecast lead."""
    return [f"{column} = {v:g}" for v in values]


def range_predicates(column: str, bounds: Sequence[float]) -> list[str]:
    """Adjoining ranges cut at ``bounds``; nulls go with the first range.

    Choose the bounds so that every range holds about as many rows.
    """
    cuts = sorted(bounds)
    out = [f"{column} <= {cuts[0]:g} or {column} is null"]
    out += [f"{column} > {low:g} and {column} <= {high:g}" for low, high in zip(cuts, cuts[1:])]
    return [*out, f"{column} > {cuts[-1]:g}"]


def write_table(
    df: DataFrame, db: Database, table: str, mode: str = "append", batch: int = 20000
) -> None:
    """Write rows in batches from every partition.

    For a keyed upsert write to a staging table and let the server merge it:
    a retried task may send its rows twice, which a keyed merge absorbs.
    """
    properties = {**db.properties, "batchsize": str(batch)}
    df.write.jdbc(db.url, table, mode=mode, properties=properties)
