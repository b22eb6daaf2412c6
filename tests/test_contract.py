"""The driver contract: bench.py prints one JSON line with the agreed keys,
and __spark_entry__ exposes matching query and oracle names."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEATS="1",
               BENCH_CPUS="2", BENCH_QUERIES="half_hour_floor,sync_dimension")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert res.returncode == 0 and len(lines) == 1, res.stderr[-2000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"half_hour_floor", "sync_dimension"}
    assert "errors" not in out


def test_queries_and_oracle_names_match():
    from shiftwise.plans.catalogue import QUERIES
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(QUERIES) == 53
    for sql in E.oracle_sql().values():
        assert sql.strip()


def test_reporting_part_works_without_the_corpus_operators(tmp_path):
    """With shiftwise/llm and corpus_pipeline.py gone the rest still imports."""
    import shutil
    shutil.copytree(os.path.join(ROOT, "shiftwise"), tmp_path / "shiftwise",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as E; from shiftwise.plans.catalogue import QUERIES; "
            "assert set(E.queries()) == set(QUERIES) == set(E.oracle_sql()); print('fine')")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=120)
    assert res.stdout.strip().endswith("fine"), res.stderr[-2000:]


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash", "shiftwise.llm", "corpus_pipeline"])
def test_entry_imports_without_optional_modules(missing):
    code = (f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules[{missing!r}] = None\n"
            f"sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as E\n"
            "from shiftwise.plans.catalogue import QUERIES\n"
            "assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
