"""The driver contract: __spark_entry__ functions and bench.py's JSON line."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E
from tidemark.plans.catalog import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_functions(spark):
    first, second = E.entry(spark), E.entry(spark)
    assert first.schema == second.schema and first.count() > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(qs) and set(sqls) <= set(qs) and set(QUERIES) <= set(sqls)
    assert all(callable(f) for f in qs.values()) and all(isinstance(s, str) and s.strip() for s in sqls.values())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "month_parse", "freshness"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=REPO)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"month_parse", "freshness"}
    assert d["errors"] == {} and d["value"] == round(sum(d["queries"].values()), 3)
