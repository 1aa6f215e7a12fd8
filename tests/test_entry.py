"""The entry module, whole and without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *sorted(n for n in e.queries() if n == 'pipeline' or n.startswith('op')))"


def names(root):
    run = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_queries_with_and_without_the_corpus_operators(tmp_path):
    whole, copy = names(ROOT), tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for gone in ("postlake/llm", "tests/llm"):
        shutil.rmtree(copy / gone, ignore_errors=True)
    few = names(copy)
    assert few[2:] == [] and int(few[0]) == int(few[1]) == int(whole[0]) - len(whole[2:])
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert names(copy) == few
