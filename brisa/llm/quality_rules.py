"""Quality rules: word and repetition counts of each text, and lines that a host repeats.

The base rules look at one document: too few words, or too many words inside repeated windows.
The method's rule looks across documents: lines are normalised and hashed, the distinct documents
that hold each line are counted per host (the `source` column), lines above the host's limit are
removed, and a document that keeps too little without them, or fewer words than any needs, is rejected.

Distinct documents: copies must not turn each other's lines into boilerplate.  A document is
counted under the digest of all its normalised lines, for its lines and for its host alike, so
repeating a page changes no other page's verdict.  Pages that differ in a line are different.

* Null or empty texts have no words and are rejected by the base rule.
* A null source is a host of its own.
* Rows that repeat a doc_id are judged one by one and give a row each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from brisa.llm.common import slices, stored, texts, windows, words_of

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
# A line is boilerplate on a host if more than this many of its distinct documents hold it,
MIN_DOCUMENTS, HOST_PERCENT = 20, 5
# and a document is depleted if it keeps less than this share of its words.
KEEP_PERCENT = 30
_SPACES = " \t\n\v\f\r"
_DIGITS = re.compile(r"\d+")
_COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "page long, lines array<struct<line:long,words:int>>"
)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of `width` words that the list holds twice or more, the first included."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    seen = windows(ids + np.uint64(1), width)
    order = np.sort(seen)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(seen, twice)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:-width] += starts
    edge[width:] -= starts
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_key(line: str) -> int:
    """Hash of a line without case, digits' values and the width of white space."""
    return xxhash.xxh3_64_intdigest(_DIGITS.sub("0", " ".join(line.lower().split())).encode("utf-8", "surrogatepass"))


def measures(text: str) -> tuple[int, int, int, int, int, int, list[dict]]:
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    spread: dict[int, int] = {}
    for x in lines:
        k = line_key(x) - 2**63
        spread[k] = spread.get(k, 0) + len(words_of(x))
    page = xxhash.xxh3_64_intdigest(np.sort(np.fromiter(spread, np.int64, len(spread))).tobytes()) - 2**63
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        page,
        [{"line": k, "words": n} for k, n in spread.items()],
    )


def _measured(rows: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))]
        for batch in slices(batches):
            found = [measures(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), batch.column("row_key")]
                + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "host", "row_key", *(c.split()[0] for c in _COLUMNS.split(", "))],
            )

    rows = rows.select("doc_id", "text", "host", "row_key")
    return rows.mapInArrow(run, f"doc_id long, host string, row_key long, {_COLUMNS}")


def verdicts(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    host_percent: float = HOST_PERCENT,
    keep_percent: float = KEEP_PERCENT,
) -> DataFrame:
    """doc_id, row_key, the counts, base_failed, kept, n_boilerplate_words and frequent_lines for each row.

    `row_key` hashes the row's text and host, to tell rows of one doc_id apart.  `frequent_lines` has the
    hashes of the row's lines above the limits, null if there are none.
    """
    host = F.coalesce(docs["source"].cast("string"), F.lit("")).alias("host")
    rows = texts(docs.select("doc_id", "text", host), "host")
    rows = rows.withColumn("row_key", F.xxhash64("text", "host"))
    held = stored(_measured(rows), "quality")
    lines = held.select("doc_id", "row_key", "host", "page", F.inline("lines"))
    # one entry for each distinct document of a line, then counts: both combine before the shuffle
    counted = lines.select("host", "line", "page").distinct().groupBy("host", "line").agg(F.count("*").alias("held_by"))
    hosts = held.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_documents"))
    frequent = (
        counted.where(F.col("held_by") > min_documents)
        .join(hosts, "host")
        .where(F.col("held_by") * 100 > F.col("host_documents") * host_percent)
        .select("host", "line")
    )
    lost = (
        lines.join(frequent, ["host", "line"], "left_semi")
        .select("doc_id", "row_key", "line", "words")
        .distinct()
        .groupBy("doc_id", "row_key")
        .agg(F.sum("words").alias("lost"), F.collect_list("line").alias("frequent_lines"))
        .select(F.col("doc_id").alias("lost_id"), F.col("row_key").alias("lost_key"), "lost", "frequent_lines")
    )
    # a row per row of the table, also where rows repeat; each finds its own sum
    same = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("row_key") == F.col("lost_key"))
    gone, n_words = F.coalesce("lost", F.lit(0)), F.col("n_words")
    left = n_words - gone
    failed = (n_words < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * n_words)
    depleted = (gone > 0) & ((left * 100 < n_words * keep_percent) | (left < MIN_WORDS))
    return held.join(lost, same, "left").select(
        "doc_id",
        "row_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        gone.cast("long").alias("n_boilerplate_words"),
        "frequent_lines",
    )


def without_lines(text: str, frequent: set[int]) -> str:
    """The text without the lines whose hash is in `frequent`; lines without a word stay."""
    kept = (x for x in text.split("\n") if not x.strip(_SPACES) or line_key(x) - 2**63 not in frequent)
    return "\n".join(kept)


@F.pandas_udf(StringType())
def _rewritten(text: pd.Series, frequent: pd.Series) -> pd.Series:
    pairs = zip(text, frequent, strict=True)
    return pd.Series([None if t is None else without_lines(t, set(f.tolist())) for t, f in pairs], dtype=object)


def keep_good(docs: DataFrame, **limits: float) -> DataFrame:
    """`docs` without the rows that the rules reject, and texts without the lines above the limits.

    Only texts with such lines are rewritten; other columns are as they were.
    """
    good = verdicts(docs, **limits).where("kept").select(
        F.col("doc_id").alias("_q_id"), F.col("row_key").alias("_q_key"), F.col("frequent_lines").alias("_q_lines")
    )
    good = good.dropDuplicates(["_q_id", "_q_key"])
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    key = F.xxhash64(text, F.coalesce(docs["source"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(good["_q_id"]) & (key == good["_q_key"])
    hit = F.col("_q_lines").isNotNull()
    shorter = F.when(hit, _rewritten(F.when(hit, text), "_q_lines")).otherwise(docs["text"])
    return docs.join(good, same).select(*(shorter.alias(c) if c == "text" else docs[c] for c in docs.columns))
