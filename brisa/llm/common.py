"""What the corpus operators share: input columns, word hashing, stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.session import shared_dir

# Odd multipliers of the window hashes, drawn once from a fixed seed.
_DRAW = np.random.default_rng(20240229)
MULTIPLIERS = _DRAW.integers(1, 2**63, size=(4, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only what an operator reads: the id as long, the text with null as empty, and `more`.

    Other columns, whatever they are called, never reach an operator's own names.
    """
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        *(docs[c] for c in more),
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written under the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession, batch: int | None = None) -> Iterator[None]:
    """Shuffle files of each query run inside go when it ends, not when the driver next collects garbage.

    For queries that store tables: what was stored needs them no more, and on disk they would add up.
    `batch` bounds the rows of an Arrow batch, which lies in memory of the executor and of its worker.
    """
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch:
        settings["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id", small: int = 1_000_000) -> DataFrame:
    """Rows of `df` whose `column` is in the stored `ids`; up to `small` counted ids (16 MB) are broadcast."""
    ids = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
    return df.join(F.broadcast(ids) if ids.count() <= small else ids, column, "left_semi")


def below(total: int, n: int) -> int:
    """A bound under which about twice `n` of `total` evenly spread signed 64-bit hashes lie."""
    return 2**63 - 1 if total <= 2 * n else -(2**63) + 2**64 * 2 * n // total


def smallest(rows: DataFrame, n: int, *ties: str) -> DataFrame:
    """The `n` rows of a stored table with the smallest `draw`, a hash.

    Rows are counted first and cut by their hash, so that all tasks together send about 2 * n rows
    to the one that picks, however many tasks there are.
    """
    return rows.where(F.col("draw") <= below(rows.count(), n)).orderBy("draw", *ties).limit(n)


class WordHashes(dict):
    """64-bit hashes of words, remembered; the memory is emptied when it grows past a bound."""

    def __init__(self, most: int = 400_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each run of `width` values (none if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * MULTIPLIERS[seed, k]
    return mix(out)


def words_of(text: str) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed, carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task holds does not depend on a session's batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hex_sha256(column: Column) -> Column:
    return F.lower(F.sha2(column, 256))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component), the smallest node reachable.

    Alternates two star steps: every node's larger neighbours, then its smaller ones, are tied
    to the smallest node known to it.  Each step is a grouped minimum and a join, so a node with
    any number of links is spread over tasks; the links are stored after each round, and paths
    shorten geometrically.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: larger neighbours of a go to the smallest node around a
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.union(low.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        # small star: a and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        # done when every node points straight at a node that points nowhere
        again = after.select(F.col("b").alias("a")).join(after.select("a").distinct(), "a", "left_semi")
        many = after.groupBy("a").count().where("count > 1").select("a")
        links = after
        if again.union(many).isEmpty():
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
