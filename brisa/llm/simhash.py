"""SimHash near-duplicates by the general pigeonhole principle with thresholds of each fingerprint's own.

Fingerprints of 64 bits are cut into four parts of 16 bits; bits that go together in the corpus are
put into one part, so that values of different parts are as independent as can be.  If two
fingerprints differ in 3 bits at most, then for any thresholds t_1..t_4 (-1: part not looked at)
with a sum of 3 - 4 + 1 = 0 some part differs by t_i bits at most.  Each fingerprint picks its own:
a dynamic programme over the parts takes the thresholds with the smallest expected number of
candidates, from the number of fingerprints that hold each value of each part.  These counts cover
the whole table; there are 4 x 65,536 of them at any size.

A fingerprint is filed under its value in every part, and probes the values within its thresholds.
What meets under a value is verified on all 64 bits.  Where more than LIMIT fingerprints meet, they
are filed again by the bits that are not yet known to agree, cut into four parts once more: with 3
differences left, one of these agrees.  So a group stays within LIMIT (with 12 bits left
there cannot be more), large groups of near copies included, and no link is lost.  A group gives its links as a
forest, at most one row for each member, never as all pairs.

* A word is a run of anything but ASCII white space; A-Z are lower-cased.  A text without words has
  fingerprint zero, a text of one or two words hashes these as one shingle.
* Rows with equal fingerprints are one node.  A component is named by its smallest doc_id; rows
  without doc_id take part like others, and are in component null if no member has an id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brisa.llm.common import components, mix, slices, stored, texts

BITS, RADIUS, PARTS, WIDTH = 64, 3, 4, 16
WORDS, SEED = 3, 42
LIMIT = 4096  # fingerprints that are compared in one group; 2^12, see above
PROBE = 4  # candidates that one probe counts for
_BLOCK = 65_536
_FEW = 32


def fingerprint(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(WORDS, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    count, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _BLOCK):
        spans = zip(first[at : at + _BLOCK], last[at : at + _BLOCK], strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = (2 * count > len(first)).astype(np.uint8)
    return int.from_bytes(np.packbits(over, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits): the fingerprint of every row as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "bits"])

    return texts(docs).mapInArrow(run, "doc_id long, bits long")


def set_bits(values: np.ndarray) -> np.ndarray:
    """(n, 64) zeros and ones, lowest bit first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def gathered(values: np.ndarray, places: list[int]) -> np.ndarray:
    """The bits at `places` of each value, packed in that order."""
    out = np.zeros(len(values), np.int64)
    for k, place in enumerate(places):
        out |= ((values >> np.uint64(place)) & np.uint64(1)).astype(np.int64) << k
    return out


def together(distinct: DataFrame) -> np.ndarray:
    """Correlation of the 64 bits over all distinct fingerprints (64 x 64 sums, whatever the size)."""
    names = ["a", "b", "n"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS), np.int64)
        for batch in slices(batches, 8192):
            ones = set_bits(batch.column("bits").to_numpy().view(np.uint64)).astype(np.float64)
            total[:BITS] += (ones.T @ ones).astype(np.int64)
            total[BITS] += len(ones)
        a, b = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total.ravel())], names)

    found = distinct.select("bits").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    total = np.zeros((BITS + 1, BITS))
    for a, b, n in found.collect():
        total[a, b] = n
    n = max(total[BITS, 0], 1)
    share = np.diag(total[:BITS]) / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return (total[:BITS] / n - np.outer(share, share)) / np.outer(spread, spread)


def grouped_bits(correlation: np.ndarray) -> list[list[int]]:
    """Four parts of 16 bits; each starts with the two free bits that go together most and takes what fits best."""
    strength = np.abs(correlation)
    np.fill_diagonal(strength, 0)
    free, parts = set(range(BITS)), []
    while free:
        left = sorted(free)
        among = strength[np.ix_(left, left)]
        part = [left[k] for k in np.unravel_index(among.argmax(), among.shape)]
        if part[0] == part[1]:  # nothing goes together
            part = left[:2]
        free -= set(part)
        while len(part) < WIDTH:
            best = max(sorted(free), key=lambda k: strength[k, part].sum())
            part.append(best)
            free.discard(best)
        parts.append(part)
    return parts


def ball(radius: int, width: int = WIDTH) -> np.ndarray:
    """All masks of `width` bits with `radius` ones at most."""
    masks = np.arange(1 << width)
    return masks[np.bitwise_count(masks) <= radius]


def prices(counts: np.ndarray) -> np.ndarray:
    """[part, steps, value]: candidates of looking up a value with threshold steps - 1, and of its probes."""
    out = np.zeros((PARTS, RADIUS + 2, 1 << WIDTH))
    values = np.arange(1 << WIDTH)
    for part in range(PARTS):
        reach = [counts[part].astype(float)]  # fingerprints at each exact distance
        for distance in range(1, RADIUS + 1):
            # flipping each bit in turn counts a neighbour as often as it can be reached
            stepped = sum(reach[-1][values ^ (1 << k)] for k in range(WIDTH))
            if distance > 1:
                stepped -= (WIDTH - distance + 2) * reach[-2]
            reach.append(stepped / distance)
        near = np.cumsum(reach, axis=0)
        probes = [len(ball(r)) for r in range(RADIUS + 1)]
        for r in range(RADIUS + 1):
            out[part, r + 1] = near[r] + PROBE * probes[r]
    return out


def thresholds(held: np.ndarray, price: np.ndarray) -> np.ndarray:
    """(n, 4) steps of each fingerprint, from its values (n, 4): cheapest with RADIUS + 1 in all."""
    n, need = len(held), RADIUS + 1
    best = np.full((need + 1, n), np.inf)
    best[0] = 0
    chosen = np.zeros((PARTS, need + 1, n), np.int8)
    for part in range(PARTS):
        after = np.full_like(best, np.inf)
        for total in range(need + 1):
            for steps in range(total + 1):
                cost = best[total - steps] + price[part, steps][held[:, part]]
                better = cost < after[total]
                after[total][better] = cost[better]
                chosen[part, total][better] = steps
        best = after
    out, left = np.zeros((n, PARTS), np.int64), np.full(n, need)
    for part in reversed(range(PARTS)):
        out[:, part] = chosen[part, left, np.arange(n)]
        left -= out[:, part]
    return out


def value_counts(distinct: DataFrame, parts: list[list[int]]) -> np.ndarray:
    """Fingerprints that hold each value of each part: 4 x 65,536 numbers at any size."""
    names = ["part", "value", "n"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, 1 << WIDTH), np.int64)
        for batch in batches:
            values = batch.column("bits").to_numpy().view(np.uint64)
            for k, places in enumerate(parts):
                total[k] += np.bincount(gathered(values, places), minlength=1 << WIDTH)
        part, value = np.nonzero(total)
        columns = pa.array(part), pa.array(value), pa.array(total[part, value])
        yield pa.RecordBatch.from_arrays(list(columns), names)

    found = distinct.select("bits").mapInArrow(run, "part long, value long, n long")
    found = found.groupBy("part", "value").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((PARTS, 1 << WIDTH), np.int64)
    counts[found["part"], found["value"]] = found["n"]
    return counts


def filed(distinct: DataFrame, parts: list[list[int]], counts: np.ndarray) -> DataFrame:
    """(key, bits, asks): each fingerprint under its values, and under those that it probes."""
    price = prices(counts).astype(np.float32)
    balls = [ball(r) for r in range(RADIUS + 1)]
    here = counts > 0
    names = ["key", "bits", "asks"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            values = batch.column("bits").to_numpy().view(np.uint64)
            held = np.stack([gathered(values, places) for places in parts], axis=1)
            steps = thresholds(held, price)
            keys, rows, asks = [], [], []
            for part in range(PARTS):
                own = (np.int64(part) << WIDTH) + held[:, part]
                keys.append(own)
                rows.append(np.arange(len(values)))
                asks.append(steps[:, part] > 0)
                for radius in range(1, RADIUS + 1):
                    far = np.flatnonzero(steps[:, part] == radius + 1)
                    near = held[far, part][:, None] ^ balls[radius][balls[radius] > 0][None, :]
                    row, at = np.nonzero(here[part][near])  # values nobody holds need no probe
                    keys.append((np.int64(part) << WIDTH) + near[row, at])
                    rows.append(far[row])
                    asks.append(np.ones(len(row), bool))
            bits = values.view(np.int64)[np.concatenate(rows)]
            columns = pa.array(np.concatenate(keys)), pa.array(bits), pa.array(np.concatenate(asks))
            yield pa.RecordBatch.from_arrays(list(columns), names)

    return distinct.select("bits").mapInArrow(run, "key long, bits long, asks boolean")


def forest(values: np.ndarray, asks: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each value the first place of what links of at least one asking member reach."""
    label = np.arange(len(values))
    left, start = np.arange(len(values)), 0
    while len(left):
        front, left = left[:1], left[1:]
        root = front[0]
        label[root] = root
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            for at in range(0, len(front), 256):
                part = front[at : at + 256]
                differs = np.bitwise_count(values[part][:, None] ^ values[left][None, :]) <= radius
                reached |= (differs & (asks[part][:, None] | asks[left][None, :])).any(axis=0)
            front, left = left[reached], left[~reached]
            label[front] = root
        start += 1
    return label


def _group_links(key: np.ndarray, values: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
    """Links of whole groups, sorted by key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    # groups of a few members: compared all at once, then only those with a link are looked at
    found = np.repeat(sizes > _FEW, sizes)
    for step in range(1, min(_FEW, sizes.max(initial=0))):
        near = (key[step:] == key[:-step]) & (asks[step:] | asks[:-step])
        near &= np.bitwise_count(values[step:] ^ values[:-step]) <= RADIUS
        found[step:] |= near
    ends: list[np.ndarray] = [np.empty((2, 0), np.int64)]
    for at in np.flatnonzero(np.add.reduceat(found, starts)) if len(key) else ():
        group = slice(starts[at], starts[at] + sizes[at])
        label = forest(values[group], asks[group])
        far = np.flatnonzero(label != np.arange(len(label)))
        ends.append(values[group][np.stack([far, label[far]])].view(np.int64))
    both = np.concatenate(ends, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def _linked(groups: DataFrame) -> DataFrame:
    """Links (a, b) inside groups of bounded size, a row for each member but the first of those it reaches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)  # the group still open
        for batch in batches:
            bits = batch.column("bits").to_numpy().view(np.uint64)
            came = batch.column("key").to_numpy(), bits, batch.column("asks").to_numpy(zero_copy_only=False)
            held = tuple(np.concatenate(x) for x in zip(held, came, strict=True))
            if not len(held[0]):
                continue
            end = np.searchsorted(held[0], held[0][-1])
            yield _group_links(*(x[:end] for x in held))
            held = tuple(x[end:] for x in held)
        yield _group_links(*held)

    dealt = groups.select("key", "bits", "asks").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def _split(crowded: DataFrame, free: list[list[int]]) -> DataFrame:
    """Rows of groups that are too large, filed anew by four parts of the bits in which they may differ.

    `free` holds these places by the number of the group's last part.
    """
    names = ["key", "past", "bits", "asks"]
    cut = [_cut(places) for places in free]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            values = batch.column("bits").to_numpy().view(np.uint64)
            key, past = batch.column("key").to_numpy().view(np.uint64), batch.column("past").to_numpy()
            keys, pasts = np.empty((len(values), PARTS), np.uint64), np.empty((len(values), PARTS), np.int64)
            for node in np.unique(past):
                rows = np.flatnonzero(past == node)
                for k, places in enumerate(cut[node]):
                    held = gathered(values[rows], places).astype(np.uint64) + np.uint64((k + 1) << 56)
                    keys[rows, k] = mix(mix(key[rows]) ^ held)  # equal by chance: compared, and not linked
                    pasts[rows, k] = node * PARTS + k
            again = pa.array(np.repeat(np.arange(len(values)), PARTS))
            rest = batch.column("bits").take(again), batch.column("asks").take(again)
            columns = [pa.array(keys.ravel().view(np.int64)), pa.array(pasts.ravel()), *rest]
            yield pa.RecordBatch.from_arrays(columns, names)

    return crowded.select(*names).mapInArrow(run, "key long, past long, bits long, asks boolean")


def _cut(places: list[int]) -> list[list[int]]:
    return [places[k::PARTS] for k in range(PARTS)]


def links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) of the distinct fingerprints in `bits` that tie together all that are within RADIUS.

    Every two linked fingerprints are joined by a path of these links, each of which holds.
    """
    parts = grouped_bits(together(distinct))
    rows = filed(distinct, parts, value_counts(distinct, parts)).withColumn("past", F.shiftright("key", WIDTH))
    free = [[b for b in range(BITS) if b not in part] for part in parts]
    found = None
    while True:
        rows = stored(rows, "filed")
        sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("asks").alias("asked")).where("n > 1 and asked")
        crowded = stored(sizes.where(F.col("n") > limit).select("key"), "crowded")
        last = crowded.isEmpty() or max(map(len, free)) <= 12
        some = _linked(rows if last else rows.join(crowded, "key", "left_anti"))
        found = some if found is None else found.union(some)
        if last:
            return found
        rows = _split(rows.join(crowded, "key", "left_semi"), free)
        free = [[b for b in places if b not in part] for places in free for part in _cut(places)]


def near_components(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, bits, component_id) for every row of `docs`."""
    rows = stored(fingerprints(docs), "fingerprints")
    classes = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("rep")), "classes")
    tied = components(links(classes, limit).select("a", "b"))
    tied = classes.join(tied.withColumnRenamed("node", "bits"), "bits", "left")
    tied = stored(tied.select("bits", "rep", F.coalesce("component", "bits").alias("root")), "tied")
    least = tied.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = tied.join(least, "root").select("bits", "component_id")
    return rows.join(labels, "bits").select("doc_id", "bits", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest doc_id.

    Rows that repeat that doc_id all stay, and rows without a doc_id.
    """
    gone = near_components(docs).where("component_id < doc_id").select(F.col("doc_id").alias("_simhash_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("_simhash_id"), "left_anti")
