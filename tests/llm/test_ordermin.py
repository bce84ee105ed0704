import hashlib
import random

import numpy as np

from brisa.llm import ordermin
from tests.llm.conftest import EDGES, prose, rows_of


def pairs(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for k, r in enumerate(rows):
        a, b = r[1] or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(a) // 2
        yield r[0], a, a[: len(a) - half] + b[:half], b


def check(rows, got):
    want = []
    for i, a, edited, b in pairs(rows):
        fa, fe, fb = map(ordermin.fingerprint, (a, edited, b))
        want.append((i, len(a), hashlib.sha256(edited.encode()).hexdigest(), ordermin.told(fa), ordermin.told(fe), ordermin.likeness(fa, fe), ordermin.likeness(fa, fb)))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_each_row_meets_the_next(table):
    draw = random.Random(3)
    ids = draw.sample(range(-500, 5000), 150)
    rows = [(i, t, "", "", 0) for i, t in zip(ids, prose(3, 150), strict=True)]
    check(rows, ordermin.compared(table(rows).repartition(5)).collect())
    check(rows[:1], ordermin.compared(table(rows[:1])).collect())
    check(rows[:2], ordermin.compared(table(rows[:2])).collect())


def test_edges(edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()]
    check(rows, ordermin.compared(edges).collect())
    assert ordermin.compared(nothing).count() == 0
    assert ordermin.fingerprints(edges).count() == len(rows)


def test_likeness_follows_edits_and_order():
    text = prose(5, 1, 5000, 300, 300)[0]
    words = text.split(" ")
    own = ordermin.fingerprint(text)
    assert ordermin.likeness(own, ordermin.fingerprint(text)) == 1

    def near(share):
        changed = list(words)
        for k in range(0, len(words), max(1, round(1 / share))):
            changed[k] = "other"
        return ordermin.likeness(own, ordermin.fingerprint(" ".join(changed)))

    assert 1 > near(0.01) > near(0.05) > near(0.3)
    # blocks in another order have nearly the same k-mers, but not the same pairs in the same order
    third = len(words) // 3
    moved = ordermin.fingerprint(" ".join(words[2 * third :] + words[third : 2 * third] + words[:third]))
    assert ordermin.likeness(own, moved) < 0.75
    assert ordermin.likeness(ordermin.fingerprint(""), own) == 0


def test_occurrences_are_numbered_in_order():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 2**63, 12, np.uint64)[draw.integers(0, 12, 500)]
    seen, want = {}, []
    for v in values.tolist():
        want.append(seen.get(v, 0))
        seen[v] = want[-1] + 1
    assert ordermin.numbered(values).tolist() == want


def test_smallest_two_of_each_order_across_blocks(monkeypatch):
    text = EDGES[9][:40_000]
    whole = ordermin.fingerprint(text)
    monkeypatch.setattr(ordermin, "_BLOCK", 97)
    assert (ordermin.fingerprint(text) == whole).all()
