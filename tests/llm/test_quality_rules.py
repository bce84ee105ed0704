import collections
import random
import re

import pytest

from brisa.llm import quality_rules as q
from brisa.llm.queries import QUERIES
from tests.llm.conftest import prose, rows_of
from tests.parity import compare, duck

#: The base rules, which SQL can express.
BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
w8 AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM w WHERE len(words) >= 8)
),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM w8) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM again) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
  (len(words) < 20 OR 100 * coalesce(covered.n, 0) > 30 * len(words)) AS base_failed
FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
"""


def test_base_rules_in_sql(spark, sf):
    got = QUERIES["op4_quality_rules"](spark, sf)
    assert compare(got.drop("n_boilerplate_words", "kept"), duck(sf), BASE_SQL) == []


def brute(words, width=8):
    seen, gone = {}, set()
    for k in range(len(words) - width + 1):
        seen.setdefault(tuple(words[k : k + width]), []).append(k)
    for starts in seen.values():
        if len(starts) > 1:
            for k in starts:
                gone.update(range(k, k + width))
    return len(gone)


def test_repeated_words():
    draw = random.Random(1)
    for _ in range(300):
        words = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 60))]
        assert q.repeated_words(words) == brute(words)


def brute_kept(rows, min_documents, host_percent, keep_percent):
    held, hosts, own = {}, {}, {}
    for i, text, _, host, _ in rows:
        lines = {q.line_key(x): 0 for x in (text or "").split("\n") if x.strip(q._SPACES)}
        for x in (text or "").split("\n"):
            if x.strip(q._SPACES):
                lines[q.line_key(x)] += len(x.encode().split())
        own[i] = lines
        hosts[host] = hosts.get(host, 0) + 1
        for k in lines:
            held.setdefault((host, k), set()).add(min((o for o in lines if o != k), default=None))
    out = {}
    for i, text, _, host, _ in rows:
        words = (text or "").encode().split()
        lost = sum(
            n for k, n in own[i].items() if len(held[host, k]) > min_documents and 100 * len(held[host, k]) > host_percent * hosts[host]
        )
        left = len(words) - lost
        failed = len(words) < 20 or 100 * brute(words) > 30 * len(words)
        out[i] = (lost, failed, not failed and not (lost and 100 * left < keep_percent * len(words)))
    return out


@pytest.fixture
def hosts():
    """Two hosts with a footer each; pages that are little but footer; many copies of one page."""
    texts = prose(4, 60)
    footer = "Read more in the archive of 2021 and share this page with all of your friends today please"
    rows = rows_of([t + "\n" + footer.replace("2021", str(2000 + k)) for k, t in enumerate(texts)], "a")
    rows += [(100 + k, f"only these {k}\n" + footer, "en", "a", 0) for k in range(6)]
    rows += [(200 + k, texts[0], "en", "a", 0) for k in range(40)]
    rows += [(300 + k, t, "en", "b", 0) for k, t in enumerate(prose(5, 30))]
    return rows + [(400, footer + "\n" + "some other words", "en", "b", 0)]


def test_boilerplate_of_a_host(table, hosts):
    limits = {"min_documents": 20, "host_percent": 5, "keep_percent": 30}
    got = {r["doc_id"]: (r["n_boilerplate_words"], r["base_failed"], r["kept"]) for r in q.verdicts(table(hosts), **limits).collect()}
    assert got == brute_kept(hosts, 20, 5, 30)
    assert not any(got[100 + k][2] for k in range(6))  # depleted
    assert all(got[i][2] for i, *_ in hosts if i not in range(100, 106))  # copies and the other host's page stay
    assert {r["doc_id"] for r in q.keep_good(table(hosts)).collect()} == {i for i, r in got.items() if r[2]}


def test_edges(edges, nothing):
    got = q.verdicts(edges)
    assert got.count() == edges.count()
    by = {r["doc_id"]: r for r in got.collect()}
    assert not by[0]["kept"] and by[0]["n_words"] == 0 and by[11]["kept"] and by[12]["kept"] and by[9]["n_words"] == 30_000
    kept = q.keep_good(edges)
    assert kept.columns == edges.columns and {r["doc_id"] for r in kept.collect()} >= {11, 12}
    assert kept.where("doc_id = 12").count() == 2
    assert q.verdicts(nothing).count() == 0 and q.keep_good(nothing).count() == 0


def navigation(pages, lines, own, seed, host="nav"):
    """Different pages of one host that share `lines` lines and have `own` more each."""
    draw = random.Random(seed)
    line = lambda n: " ".join(f"{chr(97 + draw.randrange(26))}{draw.randrange(10**6)}x".translate(LETTERS) for _ in range(n))
    shared = [line(6) for _ in range(lines)]
    return rows_of(["\n".join(shared + [line(6) for _ in range(own)]) for _ in range(pages)], host)


LETTERS = str.maketrans("0123456789", "qwertyuiop")


def test_pages_that_share_ten_lines_are_different_documents(table):
    rows = [(100 * seed + i, t, "en", f"nav{seed}", 0) for seed in range(6) for i, t, *_ in navigation(60, 10, 1, seed)]
    held = {}
    for _, text, _, host, _ in rows:
        for x in text.split("\n"):
            held.setdefault((host, x), set()).add(text)
    assert sum(len(texts) == 60 for texts in held.values()) == 60  # above both limits, on each host all ten
    for r in q.verdicts(table(rows)).collect():
        assert r["n_boilerplate_words"] == 60 and not r["kept"]


def test_repeating_a_page_changes_no_other_verdict(table):
    pages = navigation(40, 3, 1, 9)
    other = prose(10, 1)[0]
    few, many = (table(pages + [(1000 + k, other, "en", "nav", 0) for k in range(n)]) for n in (1, 1500))
    told = lambda df: {r["doc_id"]: (r["n_boilerplate_words"], r["kept"]) for r in q.verdicts(df).where("doc_id <= 1000").collect()}
    few, many = told(few), told(many)
    assert few == many and all(few[i] == (18, False) for i in range(40))


def test_frequent_lines_are_removed_and_depleted_documents_rejected(table):
    """Texts and verdicts against plain counts, on a host whose pages share navigation lines."""
    footers = [f"Menu {k} " + " ".join(f"{chr(97 + k)}{chr(97 + j)}bar" for j in range(11)) for k in range(6)]
    rows, texts = [], []
    for k in range(200):
        own = [f"page {chr(97 + k % 26)}{chr(97 + k // 26)} tells of {w}" for w in ("winter", "rivers and boats", "old maps", "stone")]
        body = own[: 1 + k % 4]
        longer = [" ".join(f"{chr(97 + (k * 7 + j) % 26)}{chr(97 + j % 23)}x{chr(97 + k % 21)}" for j in range(60))] if k % 3 else []
        texts.append("\n".join([footers[0], "", *body, *longer, *footers[1:], "  "]))
        rows.append((k, texts[-1], "en", "site", len(texts[-1])))
    rows += [(1000 + k, f"{footers[0]}\nthe only page of its host {k}", "en", f"other{k}", 1) for k in range(30)]
    df = table(rows)
    found = {r["doc_id"]: r for r in q.verdicts(df).collect()}
    kept = {r["doc_id"]: r["text"] for r in q.keep_good(df).collect()}
    key = lambda x: re.sub(r"\d+", "0", " ".join(x.lower().split()))
    holders = collections.Counter(k for t in texts for k in {key(x) for x in t.split("\n") if x.strip()})
    frequent = {k for k, n in holders.items() if n > 20 and 100 * n > 5 * len(texts)}
    assert {key(f) for f in footers} <= frequent
    rejected = 0
    for k, text in enumerate(texts):
        lines = text.split("\n")
        left = [x for x in lines if not x.strip() or key(x) not in frequent]
        words, before = len(" ".join(left).split()), len(text.split())
        depleted = words < before and (100 * words < 30 * before or words < 20)
        assert found[k]["n_boilerplate_words"] == before - words
        assert found[k]["kept"] == (not found[k]["base_failed"] and not depleted)
        assert (k in kept) == found[k]["kept"]
        if k in kept:
            assert kept[k] == "\n".join(left)
        rejected += depleted and not found[k]["base_failed"]
    assert rejected > 20 and len(kept) > 20
