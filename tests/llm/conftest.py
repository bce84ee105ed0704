import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside; as extra columns they must neither clash nor matter
CLASHING = ("tk", "kept", "n", "sig", "lines", "place", "block", "rank", "found", "spans", "score", "part", "host", "removed", "length")


def rows_of(texts, source="s"):
    return [(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(rows, SCHEMA)

    return make


EDGES = [
    None,
    "",
    " \t\n \x0b\x0c\r ",
    "one",
    "one two three four",
    "One  two\nthree\tfour",
    "\n\nlast line only",
    "é ñ 漢字 \U0001f600 \x1c\x85 x",
    "<|endoftext|> and <|startoftext|>",
    " ".join(f"long{i % 977}" for i in range(30_000)),
    "x" * 50_000,
    "same text as its copy, word for word, line for line, and long enough to have many runs of words in it",
    "same text as its copy, word for word, line for line, and long enough to have many runs of words in it",
]


@pytest.fixture
def edges(spark, table):
    """Nulls, empty and very long texts, copies, repeated rows, a null id and source, clashing columns."""
    rows = rows_of(EDGES)
    rows += [rows[-1], (3, "one", None, None, None), (None, "a text without an id", "en", "s", 3), (-7, None, None, None, None)]
    df = table(rows)
    for c in CLASHING:
        df = df.selectExpr("*", f"'other' AS {c}")
    return df


@pytest.fixture
def nothing(table):
    return table([])


def prose(seed, documents, words=400, low=20, high=120):
    """Documents of random words, lines included."""
    draw = random.Random(seed)
    vocabulary = [f"{chr(97 + k % 26)}{k}" for k in range(words)]
    out = []
    for _ in range(documents):
        text = [draw.choice(vocabulary) for _ in range(draw.randint(low, high))]
        for k in range(9, len(text), 10):
            text[k] += "\n"
        out.append(" ".join(text).replace("\n ", "\n"))
    return out
