"""Text quality by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled set is the corpus itself.  A linear
model over binned text measures minimises the non-negative unbiased risk

    prior * loss(positive, +) + max(0, loss(unlabelled, -) - prior * loss(positive, -))

where the prior is the share of good documents in the corpus, estimated from the data: a first
model ranks positives above unlabelled texts, and the smallest ratio, over all score thresholds
that enough positives pass, of unlabelled to positive texts above it bounds the prior from above.
Labels of bad documents are not used at all.

Measures look at the text only.  They are made for every document and stored; the model is fitted
on at most `positives` and `unlabelled` rows, those with the smallest hashes of their ids.

* Null and empty texts have measures of zero and are scored like any other.
* Labels: rows that repeat a doc_id count as positive if any of them says 1; null labels count as
  none.  Without positives to learn from every score is 0.5.
* Rows of documents that repeat give a row each; a null doc_id is scored and is not held out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brisa.llm.common import slices, smallest, stored, texts

POSITIVES, UNLABELLED, BINS, THRESHOLD = 20_000, 40_000, 16, 0.3
BLOCK = 4000  # characters compressed at a time
MARKS = "!?.,;:#*$%&|<>\"'()[]{}=_/\\@+-~^"
_UPPER, _LETTER, _DIGIT = re.compile(r"[^\W\d_]"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")
_RUN = re.compile(r"(.)\1{2,}")


def measures(text: str) -> list[float]:
    """Shares and lengths that do not name a language, a source or a topic."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * (23 + len(MARKS))
    lines = [x for x in text.split("\n") if x.strip()]
    lower = [w.lower() for w in words]
    distinct = len(set(lower))
    lengths = np.fromiter(map(len, words), float, n)
    pairs = len(set(zip(lower, lower[1:], strict=False)))
    same = sum(a == b for a, b in zip(lower, lower[1:], strict=False))
    counts = np.unique(np.fromiter(map(hash_of, lower), np.uint32, n), return_counts=True)[1]
    # blocks of one length, so that a short rest is no extreme; every character is in one
    cuts = np.linspace(0, len(text), -(-len(text) // BLOCK) + 1).astype(int).tolist()
    blocks = [text[a:b].encode("utf-8", "surrogatepass") for a, b in zip(cuts, cuts[1:], strict=False)]
    packed = [len(zlib.compress(b, 1)) for b in blocks]
    ratios = [p / len(b) for p, b in zip(packed, blocks, strict=True)]
    letters, upper = len(_UPPER.findall(text)), len(_LETTER.findall(text))
    return [
        np.log1p(n),
        distinct / n,
        distinct / np.sqrt(n),
        pairs / max(1, n - 1),
        same / max(1, n - 1),
        counts.max() / n,
        float(np.sort(counts)[-10:].sum()) / n,
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        float((lengths <= 3).mean()),
        float((lengths >= 12).mean()),
        np.log1p(len(lines)),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        letters / chars,
        upper / max(1, letters),
        len(_DIGIT.findall(text)) / chars,
        sum(w[0].isupper() for w in words) / n,
        sum(len(m) > 0 for m in _RUN.findall(text)) / n,
        sum(packed) / sum(map(len, blocks)),
        min(ratios),
        max(ratios),
        *(text.count(c) / n for c in MARKS),
    ]


def hash_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the measures of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [measures(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    return texts(docs).mapInArrow(run, "doc_id long, x array<float>")


def held_out(doc_id: Column) -> Column:
    """One document in five, by the checksum of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    cuts: list[np.ndarray]
    starts: np.ndarray
    weights: np.ndarray
    offset: float
    prior: float

    def places(self, x: np.ndarray) -> np.ndarray:
        """Which of the binary inputs each row has: one per measure."""
        return np.stack([s + np.searchsorted(q, c, "left") for s, q, c in zip(self.starts, self.cuts, x.T, strict=True)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.weights[self.places(x)].sum(axis=1) + self.offset)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(p: np.ndarray, u: np.ndarray, size: int, prior: float | None, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights for binary inputs; without a prior, plain positives against unlabelled."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    bag = lambda places, weight: np.bincount(places.ravel(), np.repeat(weight, places.shape[1]), size)
    for t in range(1, steps + 1):
        sp, su = (_sigmoid(w[x].sum(axis=1) + w[size]) for x in (p, u))
        # derivatives of the logistic losses with respect to the margins
        gp_plus, gp_minus, gu = -(1 - sp) / len(p), sp / len(p), su / len(u)
        if prior is None:
            on_p, on_u = gp_plus / 2, gu / 2
        else:
            rest = -np.log(np.maximum(1 - su, 1e-12)).mean() + prior * np.log(np.maximum(1 - sp, 1e-12)).mean()
            if rest >= 0:
                on_p, on_u = prior * (gp_plus - gp_minus), gu
            else:  # the unlabelled risk fell below nothing: step back from what was fitted too far
                on_p, on_u = prior * gp_minus, -gu
        grad = np.r_[bag(p, on_p) + bag(u, on_u) + decay * w[:size], on_p.sum() + on_u.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:size], float(w[size])


def estimated_prior(p: np.ndarray, u: np.ndarray, least: float = 0.1, delta: float = 0.1) -> float:
    """From scores of positives and unlabelled rows: the smallest upper bound over thresholds."""
    grid = np.quantile(p, np.linspace(0, 1 - least, 200))
    ps = np.array([(p >= c).mean() for c in grid])
    us = np.array([(u >= c).mean() for c in grid])
    slack = np.sqrt(np.log(4 / delta) / (2 * len(p))) + np.sqrt(np.log(4 / delta) / (2 * len(u)))
    best = int(np.argmin((us + slack) / ps))
    return float(np.clip(us[best] / ps[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    both = np.concatenate([positive, unlabelled])
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in both.T]
    starts = np.cumsum([0, *(len(q) + 1 for q in cuts)])
    model = Model(cuts, starts[:-1], np.zeros(starts[-1]), 0.0, 0.5)
    p, u = model.places(positive), model.places(unlabelled)
    # the prior's model is fitted on one half and read on the other
    w, b = _descend(p[::2], u[::2], int(starts[-1]), None)
    model.prior = estimated_prior(_sigmoid(w[p[1::2]].sum(axis=1) + b), _sigmoid(w[u[1::2]].sum(axis=1) + b))
    model.weights, model.offset = _descend(p, u, int(starts[-1]), model.prior)
    return model


def train(x: DataFrame, good: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """`good`: doc_id of trusted positives; `x`: doc_id and measures of the corpus."""
    draw = F.xxhash64(F.lit("draw"), "doc_id")
    take = lambda df, n: sorted((r["draw"], r["x"]) for r in smallest(df.select(draw.alias("draw"), "x"), n, "x").collect())
    p = take(x.join(good.select("doc_id").distinct(), "doc_id", "left_semi"), positives)
    u = take(x, unlabelled)
    if len(p) < 20 or len(u) < 20:
        return None
    return fit(*(np.array([r[1] for r in rows], float) for rows in (p, u)))


def score(docs: DataFrame, labels: DataFrame, **sample: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, learnt from labels that are not held out."""
    x = stored(measured(docs), "measures")
    good = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("good"))
    good = good.where((F.col("good") == 1) & ~held_out(F.col("doc_id")))
    model = train(x, good, **sample)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        if model is None or not len(column):
            return pd.Series(np.full(len(column), 0.5))
        return pd.Series(model.scores(np.stack(column.to_numpy()).astype(float)))

    found = x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("x").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
