import numpy as np
import pytest

from brisa.llm import pu_quality as pu
from brisa.llm.queries import QUERIES


def auc(score, y):
    order = np.argsort(np.argsort(score))
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op9_pu_quality"](spark, sf).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    own = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    score, y = np.array(own).T
    assert auc(score, y) > 0.97 and ((score >= 0.3) == (y == 1)).mean() > 0.95


def test_held_out_and_negative_labels_do_not_matter(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    changed = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality WHEN quality = 1 THEN 1 END AS quality")
    a, b = (sorted((r["doc_id"], r["score"]) for r in pu.score(docs, x).collect()) for x in (labels, changed))
    assert a == b and len({s for _, s in a}) > 10


def test_prior_is_near_the_share_of_positives():
    draw = np.random.default_rng(1)
    p = draw.normal(2, 1, 4000)
    for share in (0.3, 0.8):
        good = draw.random(8000) < share
        u = np.where(good, draw.normal(2, 1, 8000), draw.normal(-2, 1, 8000))
        assert pu.estimated_prior(p, u) == pytest.approx(share, abs=0.06)


def test_risk_without_negatives_finds_the_boundary():
    draw = np.random.default_rng(2)
    make = lambda n, good: np.stack([draw.normal(1.5 if good else -1.5, 1, n), draw.normal(0, 1, n)], axis=1)
    u = np.concatenate([make(1800, True), make(1200, False)])
    model = pu.fit(make(1500, True), u)
    right = np.r_[model.scores(make(1000, True)) >= 0.5, model.scores(make(1000, False)) < 0.5]
    assert right.mean() > 0.88


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(9, 1), (9, 0), (None, 1), (11, None)], "doc_id long, quality int")
    got = pu.score(edges, labels).collect()
    assert len(got) == edges.count() and {r["score"] for r in got} == {0.5}
    assert pu.score(nothing, labels).count() == 0 and pu.score(edges, labels.where("false")).count() == len(got)
    assert all(len(pu.measures(t)) == len(pu.measures("")) for t in ("a", " ", "\n", "!!! ...", "é" * 50))


def test_every_character_counts_in_the_compression_measures():
    draw = np.random.default_rng(5)
    text = " ".join("".join(draw.choice(list("abcdefghij"), 6)) for _ in range(6000))
    plain = np.array(pu.measures(text)[20:23])
    for at in range(0, len(text) - 3000, 3000):
        garbage = text[:at] + "abcdef " * 400 + text[at + 2800 :]
        assert not np.isclose(pu.measures(garbage)[20:22], plain[:2], rtol=0.01).any(), at
