"""Parquet tables as sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.operators.latest import latest_per_key, merge_latest, settling
from brisa.session import stored


def append_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Append rows to a table partitioned by ``by``."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Keep one micro-batch of keyed rows.

    A batch replaces only its own folder, so a replay after a failure leaves
    the same table behind.
    """
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row of every key over all batches; the later batch wins equal times."""
    batches = spark.read.parquet(path)
    ties = settling(batches, ["batch_id"], [*keys, ts])
    return latest_per_key(batches, keys, ts, ties=ties).drop("batch_id")


def compact_batches(
    spark: SparkSession, path: str, into: str, keys: Sequence[str], ts: str
) -> None:
    """Fold all batches of ``path`` into the first batch of a fresh folder ``into``.

    The old folder stays untouched; point the job and its readers at the new one.
    """
    write_batch(read_latest(spark, path, keys, ts), into, -1)


def _partition_filter(touched: Sequence[Sequence], by: Sequence[str]) -> Column:
    """Rows of the listed partitions, in a form that prunes folders."""
    first, *more = by
    values = {t[0] for t in touched}
    where = F.col(first).isin(*[v for v in values if v is not None])
    if None in values:
        where = where | F.col(first).isNull()
    if more:
        one = lambda t: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, t)])
        where = where & reduce(lambda a, b: a | b, map(one, touched))
    return where


def merge_partitions(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    by: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> list[tuple]:
    """Keyed upsert into a table partitioned by ``by``; returns the partitions it replaced.

    The partitions that updates fall into are read, merged as ``merge_latest`` does,
    and replaced; no other is read or written, and their files stay.  ``by`` is part of
    the key, so a key never moves to another partition.  What replaces them is stored
    before anything is overwritten: if the job ends in between, running it again gives
    the same table.  The list of touched partitions (days) passes through the driver.
    """
    if not set(by) <= set(keys):
        raise ValueError("partition columns have to be part of the key")
    spark = updates.sparkSession
    updates = stored(updates, "updates")
    touched = [tuple(r) for r in updates.select(*by).distinct().collect()]
    if not touched:
        return []
    try:
        target = spark.read.schema(updates.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        target = updates.limit(0)
    merged = merge_latest(target.where(_partition_filter(touched, by)), updates, keys, ts, update_cols)
    overwrite_partitions(stored(merged, "merged"), path, by)
    return touched


def save_clustered(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``keys``, one file a bucket, and read it back.

    Joins and groupings by ``keys`` (and more) of what is read need no exchange; two
    tables with the same keys and buckets meet without one.  Spark keeps the layout with
    the table's name, so ``table`` is registered in the session's catalog.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    )
    return df.sparkSession.table(table)


def refresh_months(
    days: DataFrame, path: str, months: DataFrame, keys: Sequence[str], **options
) -> None:
    """Write the month states of ``months`` (year, month) from stored days; other months stay.

    Of days stored by year and month only these folders are read.
    """
    from brisa.operators.periods import period_state

    ids = ["published_year", "published_month"]
    wanted = [tuple(r) for r in months.select(*ids).distinct().collect()]
    if wanted:
        days = days.where(_partition_filter(wanted, ids)).drop(*ids)
        overwrite_partitions(period_state(days, keys, "month", **options), path, ids)
