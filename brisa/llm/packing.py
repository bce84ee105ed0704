"""Hierarchical packing of token sequences into windows of several lengths.

1. Each document is encoded and closed by an end id.  It is cut after every `longest` ids; what
   is left over is one more piece.  Pieces carry their place and a checksum, not their ids.
2. Every piece goes to the smallest tier (a power of two) that holds it.  Tiers are packed from
   the longest to the shortest: the gap of a window is filled by the largest piece that fits,
   first of its own tier, then of shorter ones.  A window of a shorter tier is closed when it is
   exactly full; else it is opened to the next longer tier and filled on.  So only windows of the
   longest tier are ever padded, and those by less than the shortest piece that is left.
3. Only the number of pieces of each length decides the layout, so the plan is made from a table
   of at most `longest` counts, whatever the size of the corpus; runs of equal windows are one
   line of the plan.  Each piece finds its slot by its rank among pieces of its length, and ranks
   are counted in blocks of documents, so a length that most pieces have is spread over tasks.
4. Windows of one length are dealt to step groups: group g holds windows whose sum of lengths is
   `step_tokens`, each group filled by one length only, so that every step has the same cost.

Null texts are empty documents (the end id alone); an empty table gives no rows; rows that repeat
a doc_id are packed as documents of their own.
"""

from __future__ import annotations

import bisect
import functools
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from brisa.llm.common import slices, stored, texts

LONGEST, SHORTEST, STEP_TOKENS, END = 2048, 64, 65536, 1
_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, place long"


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """ids of a text by the byte-level vocabulary at `path`, as an array of 32-bit integers."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # the file writes each byte as a printable character: the printable ones stand for themselves
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {
        chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))
    }
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    made = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: made.encode_to_numpy(text, allowed_special="all")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, vocabulary: str | None = None, longest: int = LONGEST) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, place): documents encoded and cut."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in slices(batches):
            out = []
            for doc, place, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "place", "text")), strict=True):
                ids = np.append(encode(text), END).astype("<u4")
                for start in range(0, len(ids), longest):
                    part = ids[start : start + longest]
                    out.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids), place))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"],
            )

    place = F.coalesce(F.col("doc_id"), F.lit(-1)).alias("place")
    return texts(docs).select("doc_id", "text", place).mapInArrow(run, _PIECES)


def tiers(longest: int = LONGEST, shortest: int = SHORTEST) -> list[int]:
    sizes = [longest]
    while sizes[-1] > shortest:
        sizes.append(sizes[-1] // 2)
    return sizes


def plan(counts: dict[int, int], longest: int = LONGEST, shortest: int = SHORTEST) -> list[tuple[tuple[int, ...], int]]:
    """Windows (lengths of their pieces, number of such windows) for so many pieces of each length.

    Each line of the plan uses up one length or repeats a window as often as its pieces last, so
    there are at most a few lines for each length.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    sizes = sorted(left)
    out: list[tuple[tuple[int, ...], int]] = []

    def take_out(length: int, n: int) -> None:
        left[length] -= n
        if not left[length]:
            sizes.pop(bisect.bisect_left(sizes, length))

    levels = tiers(longest, shortest)
    for upper in levels:
        while sizes and (sizes[-1] > upper // 2 or upper == levels[-1]):
            window, used, level = [sizes[-1]], {sizes[-1]: 1}, upper
            gap = level - sizes[-1]
            while gap:
                # the largest length that fits and is not used up within this window
                k = bisect.bisect_right(sizes, gap) - 1
                while k >= 0 and left[sizes[k]] <= used.get(sizes[k], 0):
                    k -= 1
                if k >= 0:
                    window.append(sizes[k])
                    used[sizes[k]] = used.get(sizes[k], 0) + 1
                    gap -= sizes[k]
                elif level < longest:
                    gap, level = gap + level, 2 * level
                else:
                    break
            times = min(left[length] // n for length, n in used.items())
            out.append((tuple(window), times))
            for length, n in used.items():
                take_out(length, n * times)
    return out


def closed(filled: int, longest: int = LONGEST) -> int:
    """The length of a window: what it holds if that is a power of two, else the longest."""
    return filled if filled & (filled - 1) == 0 else longest


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    longest: int = LONGEST,
    shortest: int = SHORTEST,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: its document's columns, sequence_id, offset, window (closed length), step.

    Pieces of one length are ranked in as many blocks as a block has pieces (by document number, so
    that a result does not depend on how the input is split).
    """
    spark = docs.sparkSession
    held = stored(pieces(docs, vocabulary, longest), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    layout = plan(counts, longest, shortest)

    # windows of one closed length follow each other, so that step groups are of one length
    layout.sort(key=lambda w: -closed(sum(w[0]), longest))
    ranges, first, used = [], 0, dict.fromkeys(counts, 0)
    step, in_step, size = 0, 0, None
    for window, times in layout:
        if closed(sum(window), longest) != size:
            step, in_step, size = step + (in_step > 0), 0, closed(sum(window), longest)
        per_step = max(1, step_tokens // size)
        at = 0
        for slot, length in enumerate(window):
            # this slot takes every `same`-th piece of the range, beginning with number `inner`
            same, inner = window.count(length), window[:slot].count(length)
            upto = used[length] + same * times
            ranges.append((length, used[length], upto, same, inner, first, at, size, step, in_step, per_step))
            at += length
        for length in set(window):
            used[length] += window.count(length) * times
        first += times
        step, in_step = step + (in_step + times) // per_step, (in_step + times) % per_step
    slots = spark.createDataFrame(
        ranges or [(0,) * 11],
        "length int, low long, high long, same int, inner int, first long, at int, window int, step long, in_step long, per_step long",
    )
    # rank among pieces of one length: blocks of documents counted first, then rows inside a block
    most = max(counts.values(), default=0)
    blocks = max(1, math.isqrt(most))
    held = held.withColumn("block", F.pmod(F.xxhash64("place", "start"), F.lit(blocks)).cast("int"))
    sizes = held.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "block", F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "block").orderBy("place", "start", "ids_crc32", "doc_tokens")
    ranked = (
        held.withColumn("inside", F.row_number().over(inside) - 1)
        .join(sizes, ["length", "block"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("block", "inside", "before", "place")
    )
    # the plan has a few rows for each of `longest` lengths at most
    hit = (
        (ranked["length"] == slots["length"])
        & (ranked["rank"] >= slots["low"])
        & (ranked["rank"] < slots["high"])
        & ((ranked["rank"] - slots["low"]) % slots["same"] == slots["inner"])
    )
    copy = ((ranked["rank"] - slots["low"]) / slots["same"]).cast("long")
    return ranked.join(F.broadcast(slots), hit).select(
        "doc_id",
        "start",
        ranked["length"].cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (slots["first"] + copy).alias("sequence_id"),
        slots["at"].cast("long").alias("offset"),
        slots["window"].cast("long").alias("window"),
        (slots["step"] + ((slots["in_step"] + copy) / slots["per_step"]).cast("long")).alias("step"),
    )
