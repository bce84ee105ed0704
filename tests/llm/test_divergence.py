import random
import re
from collections import Counter, defaultdict

import pytest

from brisa.llm import divergence, queries
from tests.llm.conftest import prose
from tests.parity import compare, duck


def plain_audit(rows):
    """The same by dictionaries over whole documents."""
    scale = 10**9
    held, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(c.lower() if c.isascii() else c for c in t) for t in found]
        held[lang, source].update(found)
        seen[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= 3)
        sources = sorted(s for g, s in groups if g == lang)
        share = {}
        for s in [*sources, None]:
            counts = Counter()
            for own in sources if s is None else [s]:
                counts.update({t: n for t, n in held[lang, own].items() if t in set(kept)})
            total = sum(counts.values()) + len(kept)
            share[s] = {t: 1 + scale * (counts[t] + 1) // total for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(f(share[s][t], share[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(share[s][t], share[None][t]), t) for t in kept if held[lang, s][t] and share[s][t] > share[None][t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                found = found if part == "pair" else found[:200]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def run(df):
    return sorted(tuple(r) for r in divergence.audit(df).select("lang", "source", "part", "item", "value", "rank").collect())


def kept(df):
    occurrences = divergence.stored(divergence.term_counts(divergence.chunk_counts(df)), "occurrences")
    return {(r["lang"], r["term"]) for r in divergence.kept_terms(occurrences).collect()}


def told(df):
    return [(r["lang"], r["source"], r["text"]) for r in df.collect()]


def test_audit_equals_plain(table):
    draw = random.Random(4)
    texts = prose(12, 240, words=300, low=5, high=60)
    rows = []
    for k, t in enumerate(texts):
        words = [w + draw.choice(["", ",", ".", "!", "'s"]) if draw.random() < 0.4 else w.upper() for w in t.split(" ")]
        words += [f"rare{k // 2}", f"(rare{k // 3})", f"rare{k // 3}!"] if draw.random() < 0.7 else []
        rows.append((k, " ".join(words), draw.choice(["en", "en", "de", None]), draw.choice(["a", "a", "a", "b", "c", "d", None]), 0))
    assert run(table(rows)) == plain_audit([(lang, s, t) for _, t, lang, s, _ in rows])


def test_three_documents_by_different_chunks(table):
    """A term is kept from three documents on, whatever chunks hold it, and repeated rows count."""
    cases = {
        "three": ["alpha", "(alpha)", "alpha!"],
        "two": ["beta beta, beta!", "beta (beta)", "x"],
        "repeated": ["gamma", "gamma", "gamma."],
        "one": ["delta delta, delta; delta!", "x", "x"],
    }
    rows = []
    for lang, texts in cases.items():
        rows += [(7, t, lang, "s", 0) for t in texts] + [(8, "other", lang, "t", 0)]
    rows += [(7, "gamma", "repeated", "s", 0)]
    assert kept(table(rows)) == {("three", "alpha"), ("repeated", "gamma")}
    assert run(table(rows)) == plain_audit([(lang, s, t) for _, t, lang, s, _ in rows])


def test_repeated_rows_count_each(table):
    for times, found in ((2, set()), (3, {("en", "word")})):
        rows = [(1, "word, (word) word", "en", "s", 0)] * times + [(2, "-", "en", "t", 0)]
        assert kept(table(rows)) == found


def test_no_more_than_200_terms(table):
    rows = [(k, " ".join(f"{chr(97 + a)}{chr(97 + b)}q" for a in range(20) for b in range(20)), "en", "s", 0) for k in range(3)]
    rows += [(k, "zz", "en", "t", 0) for k in range(3, 9)]
    found = run(table(rows))
    terms = [r for r in found if r[1] == "s" and r[2] == "term"]
    assert [r[5] for r in sorted(terms, key=lambda r: r[5])] == list(range(1, 201))
    assert found == plain_audit([(lang, s, t) for _, t, lang, s, _ in rows])


def test_edge_cases(edges, nothing):
    assert run(edges) == plain_audit(told(edges))
    assert divergence.audit(nothing).collect() == []


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_query_matches_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    df = queries.QUERIES["op11_source_divergence"](spark, folder)
    assert compare(df, duck(folder), queries.ORACLES["op11_source_divergence"]) == []


def test_shares_are_exact_where_longs_end(spark):
    """Counts around the last whose product with SCALE is taken as a long."""
    counts = [0, 1, divergence.LONG - 2, divergence.LONG - 1, divergence.LONG, divergence.LONG + 1, 7 * 10**14]
    rows = [(n, total, terms) for n in counts for total, terms in ((n, 1), (n + 12345, 7), (3 * 10**15, 10**9), (0, 0))]
    got = spark.createDataFrame(rows, "n long, total long, terms long").withColumn("p", divergence.share("n")).collect()
    assert {(r["n"], r["total"], r["terms"]): r["p"] for r in got} == {
        (n, total, terms): 1 + 10**9 * (n + 1) // (total + terms) if total + terms else None for n, total, terms in rows
    }
    assert 10**9 * divergence.LONG < 2**63
