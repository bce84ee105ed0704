"""How far sources of a language differ in their words: chunks counted, each distinct one tokenized once.

A term is a run of letters and of characters beyond ASCII, A-Z lower-cased, so it never crosses
white space.  Documents are therefore cut at white space only and their chunks counted.  A task adds
up what its documents hold before anything is sent.  Counts meet by chunk; terms are taken from
each globally distinct chunk once, joined back to its counts, and meet by term.

A language keeps its V terms that at least three documents hold.  A document may hold a term in
several chunks, so documents of chunks cannot simply be added.  Of every group and chunk the
number of documents is kept, and up to two the places of these: where there are more the term is
kept anyway.  A document's place is its partition and row in the input, which a task that runs again
finds unchanged in files and stored tables.

Shares are integers of a thousand million: p = 1 + floor(10^9 (count + 1) / (N + V)).  The
divergence of a term is floor((p - q)^2 / q), a pair's the sum over all V terms.  That sum is
split exactly: what it would be without any occurrence, what each side's own terms change in it
(summed over the few distinct shares that a source has), and what terms of both change beyond
that.  So the work follows terms that two sources share, not V times the pairs.

* Null text, lang and source are read as ''.  Groups without any term have pairs, too.
* A document is a row; rows that repeat another one count again.
* Texts without letters give no term; a language without kept terms has pairs of value 0.
* An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.llm.common import slices, stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS = 3  # the two places kept of each chunk prove this bound and no larger one
SCALE, MOST_TERMS = 1_000_000_000, 200
LONG = 9_000_000_000  # counts below this, times SCALE, fit a long
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENTRIES = 1_200_000  # counted chunks that a task holds before it sends them on
FEW_GROUPS = 100_000  # groups that are broadcast, once counted; beyond, they are joined by language


def _grouped(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text"))


class _Held:
    """What the documents of a group hold: occurrences, documents, and up to two of these, by chunk."""

    def __init__(self) -> None:
        self.at: dict[bytes, int] = {}
        self.n: list[int] = []
        self.docs: list[int] = []
        self.one: list[int] = []
        self.two: list[int] = []

    def add(self, counted: dict[bytes, int], doc: int) -> None:
        at, n, docs, two = self.at, self.n, self.docs, self.two
        for chunk, times in counted.items():
            k = at.get(chunk)
            if k is None:
                at[chunk] = len(n)
                n.append(times)
                docs.append(1)
                self.one.append(doc)
                two.append(-1)
                continue
            n[k] += times
            docs[k] += 1
            if two[k] < 0:
                two[k] = doc


def chunk_counts(docs: DataFrame) -> DataFrame:
    """(grp, chunk, n, docs, low, high): occurrences, documents, and the places of one or two of these.

    `grp` is length of lang, colon, lang, source: one text to compare instead of two.  A group and
    chunk has a row from every task that met it; they lie together by chunk.
    """
    names = ["grp", "chunk", "n", "docs", "low", "high"]

    def rows(held: dict[str, _Held], start: int) -> Iterator[pa.RecordBatch]:
        for group, own in held.items():
            count = np.array(own.docs)
            columns = [
                pa.repeat(group, len(count)),
                pa.array(list(own.at), pa.binary()).cast(pa.string()), pa.array(own.n, pa.int64()), pa.array(count),
                pa.array(start + np.array(own.one), mask=count > 2), pa.array(start + np.array(own.two), mask=count != 2),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << 40
        held: dict[str, _Held] = {}
        size = place = 0
        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
            for lang, source, text in zip(*columns, strict=True):
                place += 1
                counted = Counter(text.encode("utf-8", "surrogatepass").split())
                if not counted:
                    continue
                own = held.setdefault(f"{len(lang)}:{lang}{source}", _Held())
                size -= len(own.n)
                own.add(counted, place)
                size += len(own.n)
                if size > _ENTRIES:
                    yield from rows(held, start)
                    held, size = {}, 0
        yield from rows(held, start)

    counted = _grouped(docs).mapInArrow(
        run, "grp string, chunk string, n long, docs long, low long, high long"
    )
    # already added up by task: sent as they are
    return counted.repartition("chunk")


def term_counts(chunks: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs, low, high): each distinct chunk's terms with its counts.

    The groups that hold a chunk are gathered, one entry each, next to the terms taken from it.
    """
    found = F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0))
    known = F.struct("grp", "n", "docs", "low", "high")
    distinct = (
        chunks.groupBy("grp", "chunk")
        .agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs"),
            F.min(F.least("low", "high")).alias("low"), F.max(F.greatest("low", "high")).alias("high"),
        )
        .groupBy("chunk")
        .agg(F.collect_list(known).alias("groups"))
    )
    terms = distinct.select("groups", F.explode(found).alias("term")).withColumn("term", F.translate("term", UPPER, LOWER))
    size = F.substring_index("grp", ":", 1)
    start = F.length(size) + 2
    lang = F.substr("grp", start, size.cast("int"))
    source = F.substr("grp", start + size.cast("int"))
    held = terms.select("term", F.inline("groups"))
    return held.select(lang.alias("lang"), source.alias("source"), "term", "n", "docs", "low", "high")


def kept_terms(occurrences: DataFrame) -> DataFrame:
    """(lang, term, sources) of the terms that at least three documents of the language hold.

    `sources` has each source that holds the term, with its occurrences n.

    `occurrences` is a stored table.
    """
    # a source's documents are its own: two of a term's places in it prove two
    far = F.when(F.min("low") != F.max(F.coalesce("high", "low")), 2).otherwise(1)
    by_group = (
        occurrences.repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("total"), F.greatest(F.max("docs"), far).alias("proved"))
    )
    # a term has an entry for each source at most
    several = (
        by_group.groupBy("lang", "term")
        .agg(
            F.sum("proved").alias("proved"), F.sum("total").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("sources"),
        )
        .where(F.col("total") >= MIN_DOCUMENTS)
        .select("lang", "term", (F.col("proved") >= MIN_DOCUMENTS).alias("sure"), "sources")
    )
    several = stored(several, "several")
    sure, unsure = several.where("sure"), several.where("not sure")
    # the others' places tell how many documents they are together
    places = occurrences.join(unsure.select("lang", "term"), ["lang", "term"])
    places = places.select("lang", "term", F.explode(F.array("low", "high")).alias("place"))
    proved = places.where("place is not null").distinct().groupBy("lang", "term").count()
    proved = proved.where(F.col("count") >= MIN_DOCUMENTS).select("lang", "term")
    return sure.unionByName(unsure.join(proved, ["lang", "term"], "left_semi")).drop("sure")


def share(count: str, total: str = "total") -> Column:
    """1 + floor(10^9 (count + 1) / (N + V)), exact for any count; null without terms.

    Products that fit a long are taken as longs: decimals of any width cost many times as much.
    """
    below = f"nullif({total} + terms, 0)"
    wide = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 1 AS DECIMAL(20, 0))"
    return F.expr(
        f"1 + CASE WHEN {count} < {LONG} THEN ({SCALE}L * ({count} + 1)) DIV {below} "
        f"ELSE ({wide}) DIV CAST({below} AS DECIMAL(20, 0)) END"
    )


def apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) DIV {q})"


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, terms, whole, none): N and V of each group, N of its language, share of no occurrence."""
    totals = kept.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        _grouped(docs).select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left")
        .join(totals.groupBy("lang").agg(F.sum("total").alias("whole")), "lang", "left")
        .na.fill(0, ["total", "terms", "whole"])
    )
    groups = stored(groups.withColumn("none", share("0")), "groups")
    return F.broadcast(groups) if groups.count() <= FEW_GROUPS else groups


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language."""
    here = ["lang", "source"]
    own = groups.select(*here, "total", "terms", F.col("none").alias("p0"))
    item = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("there"), F.col("none").alias("q0"))
    other = F.col("source") != F.col("item")
    # no occurrence anywhere
    base = own.join(item, "lang").where(other).select(
        *here, "item", F.expr(f"coalesce(terms * {apart('p0', 'q0')}, 0L)").alias("value")
    )
    ways = F.inline(
        F.array(
            F.struct("source", "item", F.col("forth").alias("value")),
            F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")),
        )
    )
    # terms of one side: by its distinct shares, against each other source without the term
    held = kept.select("lang", "sources", F.inline("sources")).join(own, here).withColumn("p", share("n"))
    few = held.groupBy(*here, "p0", "p").agg(F.count("*").alias("times"))
    alone = (
        few.join(item, "lang").where(other).groupBy(*here, "item")
        .agg(
            F.expr(f"sum(times * ({apart('p', 'q0')} - {apart('p0', 'q0')}))").alias("forth"),
            F.expr(f"sum(times * ({apart('q0', 'p')} - {apart('q0', 'p0')}))").alias("back"),
        )
    )
    # terms of both: each term has its sources beside it
    beyond = lambda a, b, a0, b0: f"sum({apart(a, b)} - {apart(a, b0)} - {apart(a0, b)} + {apart(a0, b0)})"
    both = (
        held.select(*here, "terms", "p", "p0", F.inline("sources").alias("item", "m"))
        .where(F.col("source") < F.col("item"))
        .join(item, ["lang", "item"])
        .withColumn("q", share("m", "there"))
        .groupBy(*here, "item")
        .agg(F.expr(beyond("p", "q", "p0", "q0")).alias("forth"), F.expr(beyond("q", "p", "q0", "p0")).alias("back"))
    )
    changes = alone.unionByName(both).select("lang", ways)
    return base.union(changes).groupBy(*here, "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's distance to the others, and its most typical terms."""
    kept = stored(kept_terms(stored(term_counts(chunk_counts(docs)), "occurrences")), "kept-terms")
    groups = _groups(docs, kept)
    everywhere = F.aggregate("sources", F.lit(0).cast("long"), lambda n, s: n + s["n"])
    typical = (
        kept.withColumn("everywhere", everywhere).select("lang", "term", "everywhere", F.inline("sources"))
        .join(groups, ["lang", "source"])
        .withColumns({"p": share("n"), "q": share("everywhere", "whole")})
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value"))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = _pairs(kept, groups).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    typical = typical.withColumn("rank", rank).where(F.col("rank") <= MOST_TERMS).withColumn("part", F.lit("term"))
    return pairs.unionByName(typical).select("lang", "source", "part", "item", "value", "rank")
