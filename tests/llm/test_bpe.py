import hashlib
import random

import pytest
from tokenizers import Tokenizer

from brisa.llm import bpe
from brisa.llm.queries import QUERIES
from tests.llm.conftest import EDGES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(bpe.default_vocabulary(), remember=500)


POOLS = [
    [chr(c) for c in range(1, 0x250)],
    [chr(c) for c in range(0x2000, 0x2100)],
    [chr(c) for c in range(0x300, 0x600)],
    [chr(c) for c in range(0x1680, 0x3100)],
    [chr(c) for c in range(1, 0xD800)],
    [chr(c) for c in range(0x1F300, 0x1F700)],
    [*"abc'strel l d\t\n\x1c\x85 <|endoftext|>", "<|endoftext|>", "<|startoftext|>", "İ", "Σ", "ΑΣ", "é"],
]


def test_same_ids_and_text_as_the_library(own, library):
    draw = random.Random(1)
    made = ["".join(draw.choice(draw.choice(POOLS[: 1 + k % len(POOLS)])) for _ in range(draw.randint(0, 40))) for k in range(2500)]
    made += [t or "" for t in EDGES] + ["ab" * 3000 + "!" * 500, "a" * 45 + " " + "é" * 70]
    for text in made:
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text).tolist()
        assert got == want, text[:100]
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_forced_cuts_are_never_inside_a_token(own):
    letters = bpe.byte_letters()
    byte = {c: b for b, c in enumerate(letters)}
    cut = 0
    for i, token in own.tokens.items():
        body = token.removesuffix(bpe.END)
        if i in own.special.values() or not token.endswith(bpe.END) or not body:
            continue
        parts = own.fragments(bytes(byte[c] for c in body))
        assert len(parts) == 1, token
    words = ["qqqzx", "xqjkz", "täöüß", "日本"]
    for w in words:
        cut += len(own.fragments(w.encode())) - 1
    assert cut > 0


def test_short_and_long_ways_of_merging_agree(own):
    draw = random.Random(2)
    for _ in range(300):
        symbols = [own.inner_id[b] for b in bytes(draw.choice(b"thanerio") for _ in range(draw.randint(1, 40)))]
        assert own.merged(list(symbols)) == own.merged_long(list(symbols))


def test_query(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op3_bpe_forced_boundaries"](spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        text = library.decode(want, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_edges(edges, nothing):
    rows = bpe.decode(bpe.encode(edges)).collect()
    assert len(rows) == edges.count()
    assert [(r["ids"], r["decoded"]) for r in rows if r["doc_id"] in (0, 1, 2, -7)] == [([], "")] * 4
    assert bpe.decode(bpe.encode(nothing)).count() == 0
