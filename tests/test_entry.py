"""The driver contract without the optional training-data parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHOW = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'tfidf' in q, 'pipeline' in q)"


@pytest.mark.parametrize("gone", [["tallyloom/llm", "tests/llm", "corpus_pipeline.py"], ["tallyloom/llm", "tests/llm"], ["corpus_pipeline.py"]])
def test_imports_without_the_optional_parts(tmp_path, gone):
    shutil.copytree(f"{ROOT}/tallyloom", tmp_path / "tallyloom", ignore=shutil.ignore_patterns(
        "__pycache__", *["llm"] * ("tallyloom/llm" in gone)))
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if name not in gone and os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": ""}
    for script in (_SHOW, "import bench"):
        out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        if script == _SHOW:
            assert out.stdout.split()[1:] == ["True", "False"]
