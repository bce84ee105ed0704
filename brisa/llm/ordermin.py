"""Order MinHash: fingerprints whose likeness falls with the edit distance of texts.

Each k-mer of a text (k code points) is numbered by its occurrence.  For each of m random orders
the two numbered k-mers that come first are taken, put back into text order and hashed together.
The fingerprint is the list of these m hashes; the likeness of two is the share of equal entries.
Unlike plain min-hashes, entries differ when the same k-mers stand in another order.

* Null texts are empty; an empty text has a fingerprint of its own, like only to itself.
* Texts shorter than k have one k-mer, the text itself.
* Rows that repeat a doc_id follow each other in the order of their texts; a null doc_id comes
  before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brisa.llm.common import MULTIPLIERS, mix, partitions, slices, texts, windows

K, SKETCHES = 8, 64
_DRAW = np.random.default_rng(11)
_SCALE = (_DRAW.integers(0, 2**31, SKETCHES, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFT = _DRAW.integers(0, 2**32, SKETCHES, np.uint32)[:, None]
_BLOCK = 8192
_RANGE_BYTES, _MOST_RANGES = 32_000_000, 10_000


def numbered(kmers: np.ndarray) -> np.ndarray:
    """How often each value has occurred before, in order."""
    bits = np.uint64(max(1, int(len(kmers)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort((kmers & ~low) | np.arange(len(kmers), dtype=np.uint64))
    key, place = packed >> bits, (packed & low).astype(np.int64)
    starts = np.r_[True, key[1:] != key[:-1]]
    out = np.empty(len(kmers), np.uint64)
    out[place] = np.arange(len(kmers)) - np.maximum.accumulate(np.where(starts, np.arange(len(kmers)), 0))
    return out


def fingerprint(text: str) -> np.ndarray:
    """The m entries, 16 bits each."""
    if not text:
        return np.zeros(SKETCHES, np.uint16)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) < K:
        kmers = mix(np.array([(points * MULTIPLIERS[2, : len(points)]).sum(dtype=np.uint64) + np.uint64(len(points))], np.uint64))
    else:
        kmers = windows(points, K)
    values = (mix(kmers + numbered(kmers) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    rows = np.arange(SKETCHES)
    best: list[np.ndarray] = []  # values and places of the smallest found, block after block
    where: list[np.ndarray] = []
    for at in range(0, len(values), _BLOCK):
        v = values[at : at + _BLOCK][None, :] * _SCALE + _SHIFT
        for _ in range(min(2, v.shape[1])):
            i = v.argmin(axis=1)
            best.append(v[rows, i])
            where.append(at + i)
            v[rows, i] = np.uint32(0xFFFFFFFF)
    order = np.argsort(np.stack(best), axis=0, kind="stable")[:2]
    places = np.sort(np.take_along_axis(np.stack(where), order, axis=0), axis=0)
    chosen = kmers[places]
    weights = MULTIPLIERS[3, : len(chosen)][:, None]
    return (mix((chosen * weights).sum(axis=0, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def told(entries: np.ndarray) -> str:
    return entries.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): hexadecimal, four digits an entry."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [told(fingerprint(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """`docs` (place, doc_id, text) dealt to ranges of doc_id, each followed by the next range's first row.

    Rows of a range share `part`; `ahead` marks the row that only serves as the last one's successor.
    The ranges are cut at quantiles, so at most 10,000 numbers pass through the driver; each text
    is shuffled once.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = min(_MOST_RANGES, max(partitions(spark), -(-total // _RANGE_BYTES)))
    cuts = docs.select(F.col("place").cast("double").alias("place"))
    cuts = np.unique(cuts.approxQuantile("place", [k / count for k in range(1, count)], 0.2 / count) if count > 1 else [])

    @F.pandas_udf("long")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, place.to_numpy().astype(float), "right"))

    parts = docs.withColumn("part", range_of("place"))
    firsts = sorted((r["part"], r["first"]) for r in parts.groupBy("part").agg(F.min("place").alias("first")).collect())
    before = {part: firsts[k - 1][0] for k, (part, _) in enumerate(firsts)}
    heads = np.array([f for _, f in firsts], np.int64)
    back = np.array([before[p] for p, _ in firsts], np.int64)

    @F.pandas_udf("long")
    def also_of(place: pd.Series) -> pd.Series:
        at = np.searchsorted(heads, place.to_numpy())
        hit = (at < len(heads)) & (heads[np.minimum(at, len(heads) - 1)] == place.to_numpy())
        return pd.Series(np.where(hit, back[np.minimum(at, len(heads) - 1)], -1))

    twice = parts.withColumn("also", also_of("place"))
    own = F.struct(F.col("part"), F.lit(False).alias("ahead"))
    other = F.struct(F.col("also").alias("part"), F.lit(True).alias("ahead"))
    targets = F.when(F.col("also") < 0, F.array(own)).otherwise(F.array(own, other))
    return (
        twice.select("place", "doc_id", "text", F.inline(targets))
        .repartition(count, "part")
        .sortWithinPartitions("part", "ahead", "place", "text")
    )


def compared(docs: DataFrame) -> DataFrame:
    """Each text against an edited one and against the next document's.

    The edited text ends, in place of its last floor(n / 2) code points, with the first as many of
    the next document (ascending doc_id, after the last the first).
    """
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("place"), "doc_id", "text")
    kinds = pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its successor: part, doc_id, text, fingerprint
        for batch in slices(batches):
            out = []
            columns = (batch.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text"))
            for part, ahead, doc, text in zip(*columns, strict=True):
                if ahead and (held is None or held[0] != part):
                    continue
                own = fingerprint(text)
                if held is not None and held[0] == part:
                    _, before, first, its = held
                    half = len(first) // 2
                    edited = first[: len(first) - half] + text[:half]
                    entries = fingerprint(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    near = likeness(its, entries), likeness(its, own)
                    out.append((before, len(first), digest, told(its), told(entries), *near))
                held = None if ahead else (part, doc, text, own)
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return with_next(rows).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
