"""The entry module, with and without the optional package."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(root):
    code = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=root, env=env, capture_output=True, text=True, check=True)
    return set(done.stdout.rpartition("NAMES")[2].split())


def test_imports_without_the_optional_package(tmp_path):
    keep = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "r", ignore=keep)
    rest = names(tmp_path / "r")
    assert "last_pair" in rest and not any(n.startswith("op") or n == "pipeline" for n in rest)
    assert rest <= names(ROOT)
