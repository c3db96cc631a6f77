"""The rest works where the training-data operators, the pipeline or what they need are not there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def copied(tmp_path, *left_out):
    for name in ("__spark_entry__.py", "lotwise"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *left_out))
        else:
            shutil.copy(source, tmp_path / name)


def core_only(folder, first=""):
    code = first + "import __spark_entry__ as e; q = e.queries(); assert 'summary_rows' in q and not any(n.startswith('op1') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, check=True, timeout=120)


def test_entry_without_them(tmp_path):
    copied(tmp_path, "llm")
    core_only(tmp_path)


def test_entry_without_a_library_they_need(tmp_path):
    copied(tmp_path)
    for library in ("tiktoken", "xxhash", "tokenizers", "regex"):
        core_only(tmp_path, f"import sys; sys.modules['{library}'] = None; ")
