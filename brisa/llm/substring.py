"""Removal of word runs that repeat an earlier document, found by difference-cover anchors.

A window is 13 consecutive words.  A word goes if a window over it also starts, word for word, in
a document with a smaller doc_id.

Positions are taken modulo 7.  {0, 1, 3} is a difference cover of 7: for any two places i and j
there is a shift below 7 that brings both into the cover.  Two equal windows at i and j therefore
hold an equal run of 7 words that starts, in both documents, at a cover position: an anchor.

1. Each document hashes the 7-word runs at cover positions only, three in seven, and the hashes
   meet by bucket.  Those that a second document holds are sent back to their documents.  Five
   bytes of a hash are sent: buckets grow with the input, and a chance hit only costs a look.
2. Each anchor that came back is extended: the up to seven windows around it are hashed to 96
   bits, besides those of the bucket, and meet by bucket with their document.  All but the smallest document of a window hear
   which of their places it covers.
3. Documents drop the covered words.

Both meetings are combined in the map task first: a chunk of documents sends each hash once, and
decides by itself what two of its own documents share.  So a run that a third of all documents
hold adds one entry per chunk to its bucket, not one per document, and buckets are as many as the
size of the input asks for.  No pair of documents is ever made.

* Null or empty texts have no words; texts of fewer than 13 words keep all of them.
* A null doc_id takes no part in matching and keeps its words.
* Rows of one doc_id never remove each other's words; if their texts differ, a hash of the text
  tells them apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brisa.llm.common import WordHashes, texts, windows, words_of

WIDTH, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WIDTH - PERIOD + 1
CHUNK_BYTES, BUCKET_ENTRIES, LEAST_BUCKETS = 6_000_000, 1_500_000, 64
#: Bytes that are sent of the hashes of anchors and of windows; the bucket tells the highest bits.
ANCHOR_BYTES, WINDOW_BYTES, PLACE_BYTES = (5,), (8, 4), (4,)
#: What travels to a bucket: documents, entries of each, hashes, places; `here` marks an answer.
_SENT = "bucket long, here boolean, docs binary, sizes binary, hashes binary, places binary"
_ANSWER = "doc_id long, tk long, found binary"


class Chunk:
    """The words of some documents as one array of hashes."""

    def __init__(self, batch: pa.RecordBatch, memory: WordHashes) -> None:
        parts = [words_of(t) for t in batch.column("text").to_pylist()]
        # without an id there is nothing to match: such a document counts as one without words
        parts = [[] if i is None else p for i, p in zip(batch.column("doc_id").to_pylist(), parts, strict=True)]
        self.ids = batch.column("doc_id").fill_null(-1).to_numpy()
        self.keys = batch.column("tk").to_numpy()
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = memory.of([w for p in parts for w in p])
        self.doc = np.repeat(np.arange(len(parts)), self.sizes)
        self.place = np.arange(len(self.words)) - self.starts[self.doc]

    def hashes(self, width: int, seed: int = 0) -> np.ndarray:
        """One for each word; those of runs that leave their document mean nothing."""
        out = np.zeros(len(self.words), np.uint64)
        got = windows(self.words, width, seed)
        out[: len(got)] = got
        return out

    def anchors(self) -> np.ndarray:
        """Where anchors start: cover positions with room for one, in documents that have a window."""
        size = self.sizes[self.doc]
        return np.flatnonzero(
            np.isin(self.place % PERIOD, COVER) & (self.place + ANCHOR <= size) & (size >= WIDTH)
        )


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most CHUNK_BYTES of text each, or of one document."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        sizes = np.fromiter((len(t) for t in batch.column("text").to_pylist()), np.int64, batch.num_rows)
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK_BYTES - n, "right"))
            if not fit and not held:
                fit = 1
            if fit:
                held.append(batch.slice(at, fit))
                n += int(sizes[at : at + fit].sum())
                at += fit
            if n >= CHUNK_BYTES or at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _packed(values: np.ndarray, sizes: tuple[int, ...]) -> bytes:
    """The lowest bytes of each column of numbers, column after column."""
    columns = np.ascontiguousarray(values.T).view(np.uint8).reshape(len(sizes), -1, 8)
    return b"".join(c[:, :n].tobytes() for c, n in zip(columns, sizes, strict=True))


def _unpacked(data: bytes, sizes: tuple[int, ...]) -> np.ndarray:
    rows = len(data) // sum(sizes)
    out = np.zeros((len(sizes), rows, 8), np.uint8)
    at = 0
    for column, n in zip(out, sizes, strict=True):
        column[:, :n] = np.frombuffer(data, np.uint8, rows * n, at).reshape(rows, n)
        at += rows * n
    return np.ascontiguousarray(out.reshape(len(sizes), -1).view(np.uint64).T)


def _send(chunk: Chunk, buckets: int, doc: np.ndarray, hashes: np.ndarray, sizes: tuple[int, ...], places: np.ndarray | None) -> dict:
    """Entries dealt to buckets by hash: one row a bucket, in order of documents."""
    bucket = (hashes[:, 0] >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((doc, bucket))
    bucket, doc, hashes = bucket[order], doc[order], hashes[order]
    places = None if places is None else places[order].astype(np.uint32)
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, int)
    out: dict[str, list] = {c.split()[0]: [] for c in _SENT.split(", ")}
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own, counts = np.unique(doc[a:b], return_counts=True)
        out["bucket"].append(int(bucket[a]))
        out["here"].append(False)
        out["docs"].append(np.stack([chunk.ids[own], chunk.keys[own]]).tobytes())
        out["sizes"].append(counts.astype(np.uint32).tobytes())
        out["hashes"].append(_packed(hashes[a:b], sizes))
        out["places"].append(b"" if places is None else places[a:b].tobytes())
    return out


def _answer(ids: np.ndarray, keys: np.ndarray, doc: np.ndarray, found: np.ndarray, size: tuple[int]) -> tuple[list, list, list]:
    """What each document is to hear: (ids, keys, bytes of its `found`)."""
    found = found.astype(np.uint64)
    order = np.argsort(doc, kind="stable")
    doc, found = doc[order], found[order]
    edges = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True]) if len(doc) else np.zeros(1, int)
    at = doc[edges[:-1]] if len(doc) else doc
    data = [_packed(found[a:b, None], size) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return ids[at].tolist(), keys[at].tolist(), data


def _own_answer(chunk: Chunk, out: dict, doc: np.ndarray, found: np.ndarray, size: tuple[int]) -> pa.RecordBatch:
    """The rows to send, and what the chunk found by itself, spread over tasks by document."""
    for i, k, data in zip(*_answer(chunk.ids, chunk.keys, doc, found, size), strict=True):
        out["bucket"].append(-1 - (i % 1_000_003))
        out["here"].append(True)
        out["docs"].append(np.array([i, k], np.int64).tobytes())
        out["sizes"].append(b"")
        out["hashes"].append(data)
        out["places"].append(b"")
    kinds = [pa.int64(), pa.bool_(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


def _received(table: pa.Table, widths: tuple[int, ...]) -> tuple[tuple, tuple]:
    """Answers that pass through, and the entries of a bucket: ids, keys, doc, hashes, places."""
    passed: tuple[list, list, list] = ([], [], [])
    ids, keys, doc, hashes, places = [], [], [], [], []
    known = 0
    for r in table.to_pylist():
        own = np.frombuffer(r["docs"], np.int64)
        if r["here"]:
            for to, x in zip(passed, (int(own[0]), int(own[1]), r["hashes"]), strict=True):
                to.append(x)
            continue
        sizes = np.frombuffer(r["sizes"], np.uint32)
        ids.append(own[: len(sizes)])
        keys.append(own[len(sizes) :])
        doc.append(np.repeat(np.arange(known, known + len(sizes)), sizes))
        hashes.append(_unpacked(r["hashes"], widths))
        places.append(np.frombuffer(r["places"], np.uint32))
        known += len(sizes)
    if not ids:
        return passed, ()
    return passed, tuple(np.concatenate(x) for x in (ids, keys, doc, hashes, places))


def _met(rows: DataFrame, widths: tuple[int, ...], size: tuple[int], decide: Callable) -> DataFrame:
    """Buckets where entries meet; `decide` picks the entries whose documents get an answer."""

    def run(table: pa.Table) -> pa.Table:
        passed, entries = _received(table, widths)
        if entries:
            ids, keys, doc, hashes, places = entries
            chosen, found = decide(ids[doc], hashes, places)
            for to, x in zip(passed, _answer(ids, keys, doc[chosen], found, size), strict=True):
                to.extend(x)
        return pa.table([pa.array(x, t) for x, t in zip(passed, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "tk", "found"])

    return rows.groupBy("bucket").applyInArrow(run, _ANSWER)


def _gathered(answers: DataFrame) -> DataFrame:
    """All answers of a document in one row; they are no more than its words."""
    return answers.groupBy("doc_id", "tk").agg(F.collect_list("found").alias("found"))


def _several(ids: np.ndarray, group: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each group of sorted entries (which begins at `first`): whether it holds several ids."""
    return np.logical_or.reduceat(ids != ids[first][group], first) if len(first) else np.zeros(0, bool)


def shared_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, tk, found): the hashes of a document's anchors that another document holds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in _chunks(batches):
            chunk = Chunk(batch, memory)
            at = chunk.anchors()
            order = np.lexsort((chunk.doc[at], h := chunk.hashes(ANCHOR)[at]))
            at, h = at[order], h[order]
            doc = chunk.doc[at]
            new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            several = _several(chunk.ids[doc], group, first)
            own = several[group]
            pair = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else own
            out = _send(chunk, buckets, doc[first], h[first, None], ANCHOR_BYTES, None)
            yield _own_answer(chunk, out, doc[own & pair], h[own & pair], ANCHOR_BYTES)

    def decide(ids: np.ndarray, hashes: np.ndarray, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(hashes[:, 0], kind="stable")
        h, doc = hashes[order, 0], ids[order]
        new = np.r_[True, h[1:] != h[:-1]]
        group, first = np.cumsum(new) - 1, np.flatnonzero(new)
        chosen = order[_several(doc, group, first)[group]]
        return chosen, hashes[chosen, 0]

    return _gathered(_met(rows.mapInArrow(run, _SENT), ANCHOR_BYTES, ANCHOR_BYTES, decide))


def _repeats(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether a smaller id has its hash, and whether its id is its hash's smallest."""
    order = np.lexsort((ids, hashes[:, 1], hashes[:, 0]))
    h, i = hashes[order], ids[order]
    new = np.r_[True, (h[1:] != h[:-1]).any(axis=1)] if len(h) else np.zeros(0, bool)
    least = i[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else i
    later = np.empty(len(h), bool)
    later[order] = i > least
    return later, ~later


def repeated_places(rows: DataFrame, anchors: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, tk, found): starts of a document's windows that a document with a smaller id holds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in _chunks(batches):
            chunk = Chunk(batch, memory)
            at, h = chunk.anchors(), chunk.hashes(ANCHOR)
            flag = np.zeros(len(chunk.words) + 1, np.int64)
            edges = np.searchsorted(at, np.r_[chunk.starts, len(chunk.words)])
            low = np.uint64(2 ** (8 * ANCHOR_BYTES[0]) - 1)
            for d, found in enumerate(batch.column("found").to_pylist()):
                if found:
                    own = at[edges[d] : edges[d + 1]]
                    flag[own[np.isin(h[own] & low, _unpacked(b"".join(found), ANCHOR_BYTES)[:, 0])]] = 1
            # a window is looked at if one of its seven possible anchors came back
            seen = np.cumsum(np.r_[0, flag])
            last = np.minimum(np.arange(len(chunk.words)) + PERIOD, len(flag))
            wanted = (seen[last] > seen[: len(chunk.words)]) & (chunk.place + WIDTH <= chunk.sizes[chunk.doc])
            at = np.flatnonzero(wanted)
            both = np.stack([chunk.hashes(WIDTH, 1)[at], chunk.hashes(WIDTH, 2)[at]], axis=1)
            doc = chunk.doc[at]
            later, least = _repeats(chunk.ids[doc], both)
            out = _send(chunk, buckets, doc[least], both[least], WINDOW_BYTES, chunk.place[at][least])
            yield _own_answer(chunk, out, doc[later], chunk.place[at][later], PLACE_BYTES)

    def decide(ids: np.ndarray, hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        later, _ = _repeats(ids, hashes)
        chosen = np.flatnonzero(later)
        return chosen, places[chosen]

    # a left join, as the last step has it: both then read one shuffle of the texts
    met = rows.join(anchors, ["doc_id", "tk"], "left").mapInArrow(run, _SENT)
    return _gathered(_met(met, WINDOW_BYTES, PLACE_BYTES, decide))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): per row, the words that stay, joined by one space."""
    spark = docs.sparkSession
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("tk"), "text")
    size = docs.agg(F.sum(F.octet_length(docs["text"].cast("string")))).first()[0] or 0
    # six bytes a word or more, three anchors in seven words
    buckets = max(LEAST_BUCKETS, -(-size // (14 * BUCKET_ENTRIES)))
    answers = repeated_places(rows, shared_anchors(rows, buckets), buckets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                words = words_of(text)
                n_words.append(len(words))
                if found:
                    starts = np.unique(np.frombuffer(b"".join(found), np.uint32)).astype(np.int64)
                    edge = np.zeros(len(words) + 1, np.int64)
                    edge[starts] += 1
                    np.subtract.at(edge, starts + WIDTH, 1)
                    stays = np.cumsum(edge[:-1]) == 0
                    words = [w for w, s in zip(words, stays, strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            columns = pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns[:2], columns[2].cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return rows.join(answers, ["doc_id", "tk"], "left").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string"
    )
