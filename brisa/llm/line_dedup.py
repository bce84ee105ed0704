"""Line deduplication by overlapping three-line windows, in DataFrame operations only.

A line with a character that is not white space counts; blank lines are never matched and always
stay.  Each run of three counted lines of a document is a window.  The first place of a window is
the one with the smallest (doc_id, position); the lines that any later place covers are removed.
Windows are judged on the input, so the result does not depend on the order of removals.

* A document of fewer than three counted lines has no window and stays whole.
* A null text has no lines and stays null; a null doc_id takes no part and keeps its lines.
* Rows that repeat a doc_id and its text count as one document and get equal results; rows of one
  doc_id with different texts are told apart by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from brisa.llm.common import texts

WIDTH = 3
_SPACE = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where a lambda in `use` refers to it."""
    return F.transform(F.array(value), use)[0]


def _counted(x: Column) -> Column:
    return F.length(F.regexp_replace(x, _SPACE, "")) > 0


def _lines(text: Column) -> Column:
    """The counted lines of a text with their numbers among all lines, from 0."""
    numbered = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    return F.filter(numbered, lambda s: _counted(s["line"]))


def line_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tk, at, h1, h2): 128 bits of hash for each window; `at` holds its line numbers."""

    def hashed(lines: Column) -> Column:
        def one(k: Column) -> Column:
            part = [F.element_at(lines, k + F.lit(j)) for j in range(width)]
            own = [p["line"] for p in part]
            return F.struct(
                F.array(*(p["at"] for p in part)).alias("at"),
                F.xxhash64(*own).alias("h1"),
                F.xxhash64(F.lit("second"), *own).alias("h2"),
            )

        count = F.size(lines) - F.lit(width - 1)
        return F.transform(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")), one)

    held = texts(docs).where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("tk"), "text")
    return held.select("doc_id", "tk", F.inline(_let(_lines(F.col("text")), hashed)))


def removed_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tk, removed): per document that loses lines, the numbers (from 0) of those lines.

    Windows are combined by hash before the shuffle; the join back splits a window that very many
    documents hold.  A document has no more windows than lines.
    """
    rows = line_windows(docs, width)
    place = F.struct("doc_id", "tk", "at")
    repeated = (
        rows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first < last")
        .select("h1", "h2", "first")
    )
    later = rows.join(repeated, ["h1", "h2"]).where(F.struct("doc_id", "tk", "at") > F.col("first"))
    return later.groupBy("doc_id", "tk").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("removed"))


def line_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` with its columns, `text` without the removed lines, then n_lines and n_removed.

    Columns of the input called n_lines or n_removed are replaced.
    """
    removed = removed_lines(docs, width).select(
        F.col("doc_id").alias("_line_id"), F.col("tk").alias("_line_tk"), F.col("removed").alias("_line_removed")
    )
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    joined = docs.join(
        removed, (docs["doc_id"].cast("long") == removed["_line_id"]) & (key == removed["_line_tk"]), "left"
    )
    gone = F.col("_line_removed")

    def without(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - F.lit(1)), gone)
        return F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + F.lit(1))), "\n")

    text = F.when(gone.isNull(), docs["text"]).otherwise(_let(F.split(docs["text"].cast("string"), "\n", -1), without))
    n_lines = F.size(F.filter(F.split(F.coalesce(docs["text"].cast("string"), F.lit("")), "\n", -1), _counted))
    own = [text.alias(c) if c == "text" else docs[c] for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *own,
        n_lines.cast("long").alias("n_lines"),
        F.when(gone.isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias("n_removed"),
    )
