import random
from collections import defaultdict

import pytest

from brisa.llm import substring
from tests.llm.conftest import rows_of


def brute(rows):
    words = {i: (t or "").encode().split() for i, t, *_ in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    out = {}
    for i, own in words.items():
        gone = set()
        for k in range(len(own) - 12):
            if first[tuple(own[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        out[i] = (len(own), len(gone), " ".join(w.decode() for k, w in enumerate(own) if k not in gone))
    return out


def passages(seed):
    """Runs of 8 to 30 words that documents share at every offset, besides copies."""
    draw = random.Random(seed)
    pool = [[f"r{p}x{k}" for k in range(draw.randint(8, 30))] for p in range(25)]
    texts = []
    for d in range(160):
        own = []
        for _ in range(draw.randint(0, 6)):
            own += [f"u{d}y{draw.randrange(50)}" for _ in range(draw.randint(0, 9))]
            part = draw.choice(pool)
            own += part[draw.randint(0, 3) : len(part) - draw.randint(0, 3)]
        texts.append(" ".join(own))
    texts += texts[5:9] + ["again " * 40, "again " * 50]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_words_are_those_of_every_window(table, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(substring, "CHUNK_BYTES", 3_000)  # many chunks: most meetings are in buckets
    rows = rows_of(passages(seed))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(table(rows)).collect()}
    assert got == brute(rows)


def test_the_cover_aligns_any_two_places():
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any((i + s) % 7 in substring.COVER and (j + s) % 7 in substring.COVER for s in range(substring.PERIOD))
    assert substring.ANCHOR + substring.PERIOD - 1 == substring.WIDTH


def test_edges(edges, nothing):
    got = defaultdict(list)
    for r in substring.remove_repeats(edges).collect():
        got[r["doc_id"]].append((r["n_words"], r["n_removed"], r["kept"]))
    assert sum(map(len, got.values())) == edges.count()
    assert got[0] == got[1] == got[2] == got[-7] == [(0, 0, "")]
    assert got[11][0][1] == 0 and got[12] == [(22, 22, "")] * 2  # a copy of 11, in two rows
    assert got[None] == [(5, 0, "a text without an id")]
    assert got[9][0][:2] == (30_000, 0)  # its own repeats stay
    assert substring.remove_repeats(nothing).count() == 0


def test_rows_of_one_id(table):
    text = " ".join(f"k{i}" for i in range(20))
    rows = [(1, text, "", "", 0), (1, "other " + text, "", "", 0), (2, "more words " + text, "", "", 0)]
    got = sorted((r["doc_id"], r["n_removed"]) for r in substring.remove_repeats(table(rows)).collect())
    assert got == [(1, 0), (1, 0), (2, 20)]
