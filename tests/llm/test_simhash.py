import random

import numpy as np
import pytest
import xxhash

from brisa.llm import simhash
from tests.llm.conftest import EDGES, prose, rows_of


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    spans = [words] if len(words) < 3 else [words[k : k + 3] for k in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Component of every value by comparing all pairs, as the smallest place reached."""
    values = np.array(values, np.uint64)
    label = list(range(len(values)))

    def root(k):
        while label[k] != k:
            label[k] = label[label[k]]
            k = label[k]
        return k

    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= 3):
            a, b = sorted((root(k), root(int(j))))
            label[b] = a
    return [root(k) for k in range(len(values))]


def components_of(spark, values, limit):
    distinct = sorted(set(values))
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in distinct], "bits long")
    found = simhash.components(simhash.links(df, limit).select("a", "b")).collect()
    return distinct, {int(np.int64(r["node"]).view(np.uint64)): r["component"] for r in found}


def same_groups(distinct, found):
    expected = plain_components(distinct)
    groups = {}
    for v, e in zip(distinct, expected, strict=True):
        groups.setdefault(e, set()).add(found.get(v, ("alone", v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def flipped(draw, value, bits):
    for b in draw.sample(range(64), bits):
        value ^= 1 << b
    return value


def test_fingerprint_is_the_plain_one():
    for text in [t for t in EDGES if t] + prose(3, 20) + ["A b", "a B", "x", " "]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("limit", [8, 200, simhash.LIMIT])
def test_links_equal_all_pairs(spark, limit):
    draw = random.Random(limit)
    values = [draw.getrandbits(64) for _ in range(300)]
    # chains at exactly three bits, pairs at four, and a crowd around one value
    for _ in range(150):
        values.append(flipped(draw, draw.choice(values), draw.choice([1, 2, 3, 3, 4])))
    center = draw.getrandbits(64)
    values += [flipped(draw, center, draw.choice([2, 4, 5, 6])) for _ in range(500)]
    # values that share their lower 32 bits
    low = draw.getrandbits(32)
    values += [low | draw.getrandbits(32) << 32 for _ in range(200)]
    same_groups(*components_of(spark, values, limit))


def test_links_of_bits_that_go_together(spark):
    draw = random.Random(5)
    values = []
    for _ in range(600):  # sixteen bits are copies of one another
        v = draw.getrandbits(64)
        v = v | 0x1111111111111111 if v & 1 else v & ~0x1111111111111111
        values += [v, flipped(draw, v, 3)]
    same_groups(*components_of(spark, values, 50))


def test_bits_that_go_together_share_a_part():
    correlation = np.eye(64)
    for a in range(0, 64, 4):
        for b in range(0, 64, 4):
            correlation[a, b] = 1
    parts = simhash.grouped_bits(correlation)
    assert sorted(sum(parts, [])) == list(range(64)) and [len(p) for p in parts] == [16] * 4
    assert sorted(parts[0]) == list(range(0, 64, 4))


def test_prices_count_candidates():
    draw = np.random.default_rng(2)
    counts = draw.integers(0, 3, (simhash.PARTS, 1 << 16)) * (draw.random((simhash.PARTS, 1 << 16)) < 0.01)
    price = simhash.prices(counts)
    for value in (0, 77, 65_535):
        for radius in range(4):
            masks = simhash.ball(radius)
            assert price[1, radius + 1, value] == counts[1][value ^ masks].sum() + simhash.PROBE * len(masks)


def test_thresholds_are_the_cheapest():
    draw = np.random.default_rng(3)
    price = np.zeros((4, 5, 1 << 16))
    price[:, 1:, :10] = draw.integers(0, 100, (4, 4, 10)).cumsum(axis=1)
    held = draw.integers(0, 10, (50, 4))
    steps = simhash.thresholds(held, price)
    every = [(a, b, c, 4 - a - b - c) for a in range(5) for b in range(5 - a) for c in range(5 - a - b)]
    for row, chosen in zip(held, steps, strict=True):
        cost = lambda s: sum(price[k, s[k], row[k]] for k in range(4))
        assert sum(chosen) == 4 and cost(chosen) == min(map(cost, every))


def test_documents(spark, table):
    draw = random.Random(8)
    texts = prose(8, 150, words=2000, low=100, high=300)
    for k in range(100):  # an edit of one word, copies
        words = texts[k].split(" ")
        words[draw.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts += texts[:20]
    found = {r["doc_id"]: r for r in simhash.near_components(table(rows_of(texts))).collect()}
    values = [plain_fingerprint(t) for t in texts]
    label = plain_components(values)
    assert [found[k]["bits"] % 2**64 for k in range(len(texts))] == values
    assert [found[k]["component_id"] for k in range(len(texts))] == label
    kept = simhash.keep_first(table(rows_of(texts))).collect()
    assert {r["doc_id"] for r in kept} == set(label)


def test_crowd_of_copies_and_links_in_proportion(spark):
    """A crowd gives at most one link for each member and group it meets in, never all pairs."""
    draw = random.Random(1)
    center = draw.getrandbits(64)
    values = {flipped(draw, center, draw.choice([1, 2, 3])) for _ in range(3000)}
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "bits long")
    rows = simhash.links(df, 500).count()
    assert rows <= 4**3 * len(values)
    same_groups(*components_of(spark, list(values), 500))


def test_edge_cases(edges, nothing):
    found = simhash.near_components(edges).collect()
    assert len(found) == edges.count()
    empty = [r for r in found if r["bits"] == 0]
    assert {r["component_id"] for r in empty} == {-7}
    lone = [r for r in found if r["doc_id"] is None]
    assert [r["component_id"] for r in lone] == [None]
    copies = [r for r in found if r["doc_id"] in (len(EDGES) - 1, len(EDGES) - 2)]
    assert len(copies) == 3 and {r["component_id"] for r in copies} == {len(EDGES) - 2}
    assert simhash.near_components(nothing).collect() == []
    assert simhash.keep_first(edges).columns == edges.columns
