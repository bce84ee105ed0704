import random

from brisa.llm import line_dedup
from brisa.llm.queries import OP8_SQL, QUERIES
from tests.llm.conftest import rows_of
from tests.parity import compare, duck

BLANK = " \t\x0b\x0c\r"


def brute(rows):
    lines = {i: (t or "").split("\n") for i, t, *_ in rows}
    counted = {i: [k for k, x in enumerate(own) if x.strip(BLANK)] for i, own in lines.items()}
    first, out = {}, {}
    for i in sorted(lines):
        gone = set()
        c = counted[i]
        for k in range(len(c) - 2):
            window = tuple(lines[i][j] for j in c[k : k + 3])
            if window in first:
                gone.update(c[k : k + 3])
            first.setdefault(window, (i, k))
        out[i] = (len(c), len(gone), "\n".join(x for k, x in enumerate(lines[i]) if k not in gone))
    return out


def test_against_a_walk_through_all_windows(table):
    draw = random.Random(5)
    pool = [f"line {k}" for k in range(12)] + ["", "  ", "line 3 "]
    rows = rows_of(["\n".join(draw.choice(pool) for _ in range(draw.randint(0, 25))) for _ in range(120)])
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.line_dedup(table(rows)).collect()}
    assert got == brute(rows)


def test_sql(spark, sf):
    assert compare(QUERIES["op8_line_windows"](spark, sf), duck(sf), OP8_SQL) == []


def test_plan_is_native(spark, sf):
    plan = QUERIES["op8_line_windows"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert bad not in plan


def test_edges(edges, nothing, table):
    got = line_dedup.line_dedup(edges)
    assert got.columns == [*edges.columns, "n_lines", "n_removed"] and got.count() == edges.count()
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[0]["text"] is None and by[1]["text"] == "" and by[2]["n_lines"] == 0 and by[-7]["n_removed"] == 0
    assert by[None]["text"] == "a text without an id"
    assert line_dedup.line_dedup(nothing).count() == 0
    # a long text of repeated lines, repeated rows, and one id with two texts
    long = "\n".join(["a", "b", "c"] * 4000)
    rows = [(1, long, "", "", 0), (1, long, "", "", 0), (2, "z\na\nb\nc", "", "", 0), (2, "a\nb\nc\nz", "", "", 0)]
    got = sorted((r["doc_id"], r["n_removed"]) for r in line_dedup.line_dedup(table(rows)).collect())
    assert got == [(1, 11_997), (1, 11_997), (2, 3), (2, 3)]
