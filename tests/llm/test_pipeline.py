import os
import subprocess
import sys

import corpus_pipeline
from brisa.llm import pii, quality_rules
from tests.llm import test_jaccard, test_line_dedup, test_packing, test_quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages_against_plain_versions(spark, table, sf):
    """Each stage is judged on what the one before it really gave."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS)
    stages = [f for _, f in corpus_pipeline.STAGES]
    before = rows(docs)

    after = rows(stages[0](spark, docs, sf))
    limits = quality_rules.MIN_DOCUMENTS, quality_rules.HOST_PERCENT, quality_rules.KEEP_PERCENT
    kept = {i for i, r in test_quality_rules.brute_kept(before, *limits).items() if r[2]}
    assert sorted(after) == sorted(r for r in before if r[0] in kept) and len(after) < len(before)

    before, docs = after, table(after)
    after = rows(stages[1](spark, docs, sf))
    want = test_line_dedup.brute(before)
    assert sorted(after) == sorted((i, want[i][2], *r) for i, _, *r in before if not want[i][1] or want[i][2].split())

    before, docs = after, table(after)
    after = rows(stages[2](spark, docs, sf))
    component, _ = test_jaccard.brute(before)
    assert sorted(after) == sorted(r for r in before if component[r[0]] == r[0])

    before, docs = after, table(after)
    after = rows(stages[3](spark, docs, sf))
    assert len(after) == len(before)
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    by = {r[0]: r for r in after}
    for i, text, *others in before:
        assert by[i] == (i, pii.covered(text, [tuple(s) for s in found[i]]), *others)

    test_packing.check(after, stages[4](spark, table(after), sf).collect())


def test_run_and_empty_tables(spark, sf, nothing, edges):
    assert corpus_pipeline.run(spark, sf).count() > 0
    for stage in (f for _, f in corpus_pipeline.STAGES):
        assert stage(spark, nothing, sf).count() == 0
    docs = edges
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == edges.columns
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()} == {11}  # its copy and the rest went


def test_entry_works_without_the_corpus_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "brisa", "tests", ".git"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    (tmp_path / "brisa").mkdir()
    for name in os.listdir(f"{root}/brisa"):
        if name != "llm":
            os.symlink(f"{root}/brisa/{name}", tmp_path / "brisa" / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    # the entry puts the folder of its own file first, so a copy of it is needed, not a link
    os.unlink(tmp_path / "__spark_entry__.py")
    with open(f"{root}/__spark_entry__.py") as f:
        (tmp_path / "__spark_entry__.py").write_text(f.read())
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.split()[-1:] == ["False"] and int(out.stdout.split()[0]) >= 102, out.stderr
