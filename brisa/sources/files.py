"""File tables: parquet, delimited text, JSON documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession


# Encodings Spark accepts without a setting.
PLAIN_ENCODINGS = {"us-ascii", "iso-8859-1", "utf-8", "utf-16", "utf-16be", "utf-16le", "utf-32"}


def allow_encoding(spark: SparkSession, encoding: str) -> str:
    """Switch on Java's other character sets if ``encoding`` is one of them."""
    if encoding.lower() not in PLAIN_ENCODINGS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return encoding


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """A parquet table; filter and columns reach the scan, partitions are pruned."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df if columns is None else df.select(*columns)


def read_period_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Tables named by year, month or station as one; absent columns become null."""
    frames = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
) -> DataFrame:
    """Delimited text with a declared schema: no pass over the data to infer one."""
    return (
        spark.read.schema(schema)
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("encoding", allow_encoding(spark, encoding))
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_delimited(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ";",
    encoding: str = "GBK",
) -> DataFrame:
    """Headerless delimited text; every column as text under the given names."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return read_csv(spark, path, schema, sep=sep, encoding=encoding, header=False)


def write_csv(
    df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True,
    compression: str = "none", rows_per_file: int = 0,
) -> None:
    """Delimited text, one file per partition or per ``rows_per_file`` rows of it.

    Compressed text is read by one task a file, so its files should have few rows.
    """
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("encoding", allow_encoding(df.sparkSession, encoding))
        .csv(path)
    )
