import random

import numpy as np
import pytest

from brisa.llm import licences
from brisa.llm.queries import QUERIES
from tests.llm.conftest import prose, rows_of

VARIANTS = {
    "MIT": ["Released under the MIT License.", "The code is released under the MIT license, see below."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "Proprietary": ["All rights reserved.", "(c) 2020 Someone. All rights reserved."],
}
OTHERS = ["The license to drive is in version 2 of the general work.", "mit und", "All people reserved the right seats.", "public public public"]


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(6)
    texts, want = prose(6, 200), {}
    for k in range(0, 140):
        lines = texts[k].split("\n")
        family = draw.choice([*VARIANTS, None])
        given = draw.choice(VARIANTS[family] if family else OTHERS)
        lines.insert(draw.randint(0, len(lines)), given)
        texts[k], want[k] = "\n".join(lines), family
    return rows_of(texts), want


def test_planted_notices(table, planted):
    rows, want = planted
    got = {r["doc_id"]: r for r in licences.scan(table(rows)).collect()}
    for i, text, *_ in rows:
        family = want.get(i)
        assert got[i]["families"] == ([family] if family else []), text
        assert got[i]["n_paragraphs"] == len([x for x in text.split("\n") if x.strip()])
        for f in got[i]["found"]:
            assert 0.5 <= f["probability"] <= 1 and f["cover"] >= licences.COVER


def test_held_out_variants():
    """Variants from another seed than the one the model is trained on."""
    model = licences.fit([p.split() for p in prose(8, 200)])
    rows = licences.varied(seed=99, each=20)
    p = model.probabilities([licences.grams(w) for w, _ in rows], [len(w) for w, _ in rows])
    y = np.array([k for _, k in rows])
    known = y < len(licences.NOTICES)
    assert (p.argmax(axis=1)[known] == y[known]).mean() > 0.93
    unknown = [w for w, k in rows if k == len(licences.NOTICES)]
    passed = [w for w, q in zip(unknown, p[~known], strict=True) if q[:-1].max() >= model.threshold and licences.covering(w)[licences.FAMILIES[q[:-1].argmax()]] >= licences.COVER]
    assert len(passed) <= 0.05 * len(unknown)


def test_query_finds_every_notice_line(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lines = {v: f for f, own in VARIANTS.items() for v in own}
    for r in QUERIES["op7_licence_notices"](spark, sf).collect():
        assert r["families"] == ",".join(sorted({lines[x] for x in docs[r["doc_id"]].split("\n") if x in lines}))


def test_edges(edges, nothing):
    got = licences.scan(edges).collect()
    assert len(got) == edges.count() and all(r["families"] == [] for r in got)
    assert {r["n_paragraphs"] for r in got if r["doc_id"] in (0, 1, 2, -7)} == {0}
    assert licences.scan(nothing).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:"""
BOTH = "Licensed under the MIT license or the Apache License, Version 2.0, at your option."


@pytest.fixture(scope="module")
def fitted(spark):
    from tests.llm.conftest import SCHEMA

    return licences.train(spark.createDataFrame(rows_of(prose(8, 400)), SCHEMA))


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", ";; "])
@pytest.mark.parametrize("notice,family", [(MIT, "MIT"), (GPL, "GPL-3.0"), (BSD, "BSD-3-Clause")])
def test_wrapped_notices(table, fitted, mark, notice, family):
    wrapped = "\n".join(mark + x for x in notice.split("\n"))
    text = f"import nothing\n\n{wrapped}\n\ncode = 1"
    got = licences.scan(table(rows_of([text, text.replace("\n\n", "\n")])), fitted).collect()
    assert [[(f["line"], f["family"]) for f in r["found"]] for r in got] == [[(1, family)]] * 2


def test_two_licences_in_a_sentence_and_notices_in_long_lines(table, fitted):
    long = " ".join(f"word{k % 89} of the day" for k in range(500))
    texts = [BOTH, f"Licensed under the MIT license. {long}", f"{long} {GPL.replace(chr(10), ' ')} {long} {MIT} {long}"]
    got = licences.scan(table(rows_of(texts)), fitted).collect()
    assert [r["families"] for r in got] == [["Apache-2.0", "MIT"], ["MIT"], ["GPL-3.0", "MIT"]]


def test_threshold_is_measured(fitted):
    """No floor decides: unseen near misses stay below the threshold, unseen variants pass it."""

    def passing(rows):
        p = fitted.probabilities([licences.grams(w) for w in rows], [len(w) for w in rows])
        return fitted.against_unknown(p).max(axis=1) >= fitted.threshold

    assert 0.5 < fitted.threshold < 1
    assert passing(licences.near_misses(seed=77)).mean() < 0.03
    known = [w for w, k in licences.varied(seed=98, each=10) if k < len(licences.NOTICES)]
    assert passing(known).mean() > 0.9


def test_passages_hold_every_close_run_of_pairs():
    draw = random.Random(3)
    notice = licences.words(licences.NOTICES["GPL-3.0"][0])
    for _ in range(200):
        own = [f"w{draw.randrange(50)}" for _ in range(draw.randrange(200))]
        at = draw.randint(0, len(own))
        own[at:at] = notice
        spans = licences.passages(own)
        assert any(a <= at and at + len(notice) <= b for a, b in spans)
        assert all(0 <= a < b <= len(own) and b - a <= licences.WINDOW for a, b in spans)
    assert licences.passages(["the", "mit"]) == [] and licences.passages([]) == []


def test_breaks_other_than_the_line_feed(table, fitted):
    """A carriage return is a space: one line, in which notices are found all the same."""
    got = licences.scan(table(rows_of([MIT.replace("\n", "\r\n"), MIT.replace("\n", "\r")])), fitted).collect()
    assert [(r["n_paragraphs"], r["families"]) for r in got] == [(5, ["MIT"]), (1, ["MIT"])]
