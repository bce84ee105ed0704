"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Message texts of a topic as ``value``; needs Spark's Kafka connector.

    ``max_per_trigger`` is the rate limit; offsets live in the checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def file_rows(
    spark: SparkSession,
    path: str,
    schema,
    file_format: str = "parquet",
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Rows of files as they appear under a folder."""
    reader = spark.readStream.format(file_format).schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)
