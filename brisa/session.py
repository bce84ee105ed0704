"""Session helpers: defaults for local runs and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings the jobs are written for.  The limit keeps generated methods small
# enough for the JVM to compile them: long CASE chains run several times slower
# in interpreted methods.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("brisa")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local
    master (tests on one machine) may leave it unset; a local folder is used then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="brisa-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffle_tasks(df: DataFrame) -> int:
    """Tasks of a shuffle, for rows that become far more than their bytes tell."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read again: it is computed once and keeps its rows."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
