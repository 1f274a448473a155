import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from kestrel.sources.tables import TABLES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["userId", "r_score", "f_score", "m_score"] and df.count() > 0


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(o) >= 30


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return "∅" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = sorted("|".join(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == sorted(cols)
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted("|".join(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_QUERIES="rule_match_inner", BENCH_REPEAT="1",
               BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"rule_match_inner"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6


def test_queries_without_a_library_of_the_text_operators(monkeypatch):
    """A missing third-party module takes the text queries away, and nothing else."""
    import sys
    for name in [m for m in sys.modules if m.startswith("kestrel.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    names = E.queries()
    assert len(names) > 60 and not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names
    assert set(E.oracle_sql()) <= set(names)
