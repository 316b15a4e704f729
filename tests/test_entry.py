"""The driver's entry module, with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), any(n.startswith('op1_') for n in q), 'pipeline' in q)"


def ask(folder):
    said = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": folder}, check=True)
    return said.stdout.split()


def test_entry_without_the_subpackage(tmp_path):
    for name in ("cohortry", "__spark_entry__.py"):
        (shutil.copytree if os.path.isdir(f"{REPO}/{name}") else shutil.copy)(f"{REPO}/{name}", tmp_path / name)
    shutil.rmtree(tmp_path / "cohortry" / "llm", ignore_errors=True)
    n, op1, pipeline = ask(str(tmp_path))
    assert int(n) > 60 and (op1, pipeline) == ("False", "False")


def test_entry_names_match(spark):
    assert int(ask(REPO)[0]) > 60
