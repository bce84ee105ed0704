"""Command line: python tests/run_parity.py SF_DIR [name-prefix ...]"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import __spark_entry__ as entry
from brisa.session import local_session
from tests.parity import compare, duck

sf, wanted = sys.argv[1], sys.argv[2:]
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
bad = []
oracles = entry.oracle_sql()
for name, q in entry.queries().items():
    if wanted and not any(name.startswith(w) for w in wanted):
        continue
    start = time.time()
    try:
        df = q(spark, sf)
        if name in oracles:
            problems = compare(df, con, oracles[name])
            kind = "sql"
        else:
            n = df.count()
            problems, kind = ([] if n else ["no rows"]), f"rows-only {n}"
    except Exception as e:  # report and go on
        problems, kind = [f"{type(e).__name__}: {str(e)[:1500]}"], "error"
    print(f"{'ok  ' if not problems else 'FAIL'} {time.time() - start:6.2f}s {name} [{kind}]", flush=True)
    for p in problems:
        print("      ", p[:1800], flush=True)
    if problems:
        bad.append(name)
print(f"{len(bad)} failed: {bad}")
