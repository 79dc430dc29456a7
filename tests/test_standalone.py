"""The library and its entry work in a copy without the corpus package."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = """
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 60 and set(entry.oracle_sql()) <= names
print(sorted(n for n in names if n.startswith("op") or n == "pipeline"))
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_corpus_package(tmp_path, pipeline):
    skipped = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(f"{ROOT}/pairtables", tmp_path / "pairtables", ignore=skipped)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "[]"
