import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from brisa.llm import packing
from tests.llm.conftest import EDGES, prose, rows_of


def check(rows, pieces):
    library = Tokenizer.from_file(packing.default_vocabulary())
    ids = defaultdict(list)
    for i, t, *_ in rows:
        ids[i].append([*library.encode(t or "", add_special_tokens=False).ids, packing.END])
    by = defaultdict(list)
    windows = defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
    assert set(by) == set(ids)
    for i, own in by.items():
        # each id of each row in exactly one piece
        want = Counter()
        for tokens in ids[i]:
            for a in range(0, len(tokens), packing.LONGEST):
                part = np.array(tokens[a : a + packing.LONGEST], "<u4")
                want[a, len(part), zlib.crc32(part.tobytes()), len(tokens)] += 1
        assert Counter((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in own) == want
    filled = padded = 0
    steps = defaultdict(list)
    for w in windows.values():
        at = 0
        for p in sorted(w, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert len({(p["window"], p["step"]) for p in w}) == 1
        size = w[0]["window"]
        assert size & (size - 1) == 0 and (at == size or at < size == packing.LONGEST)
        filled, padded = filled + at, padded + size
        steps[w[0]["step"]].append(size)
    for sizes in steps.values():
        assert len(set(sizes)) == 1 and sum(sizes) <= packing.STEP_TOKENS
    assert set(windows) == set(range(len(windows)))
    return filled, padded


def test_layout(table):
    rows = rows_of(prose(1, 400, 3000, 5, 900) + ["w " * 5000, "z" * 9000])
    filled, padded = check(rows, packing.pack(table(rows)).collect())
    assert padded <= 1.02 * filled


def test_same_result_however_the_input_is_split(table):
    rows = rows_of(prose(2, 60, 100, 5, 50))
    once = sorted(map(tuple, packing.pack(table(rows).coalesce(1)).collect()))
    again = sorted(map(tuple, packing.pack(table(rows[::-1]).repartition(7)).collect()))
    assert once == again


def test_plan_uses_every_piece_once_and_grows_with_lengths_only():
    draw = np.random.default_rng(3)
    counts = {int(n): int(draw.integers(1, 10**9)) for n in draw.choice(np.arange(1, 2049), 1200, replace=False)}
    plan = packing.plan(counts)
    used = Counter()
    for window, times in plan:
        assert sum(window) <= packing.LONGEST
        for length in window:
            used[length] += times
    assert used == counts and len(plan) < 20 * 2048


def test_edges(edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()]
    check(rows, packing.pack(edges).collect())
    assert packing.pack(nothing).count() == 0
    assert len(EDGES) > 5
