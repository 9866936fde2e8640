"""The library without its optional parts."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


CODE = (
    "import __spark_entry__ as e; q = e.queries(); "
    "assert len(q) > 100 and set(e.oracle_sql()) == set(q) and 'pipeline' not in q"
)


def run(folder, code=CODE):
    env = {k: x for k, x in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, env=env, timeout=120).returncode


def copied(tmp_path, *left_out):
    ignore = shutil.ignore_patterns("__pycache__", *left_out)
    shutil.copytree(os.path.join(ROOT, "opinarium"), tmp_path / "opinarium", ignore=ignore)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)


def test_entry_without_the_optional_parts(tmp_path):
    copied(tmp_path, "llm")
    assert run(tmp_path) == 0
    (tmp_path / "corpus_pipeline.py").write_text("import opinarium.llm\n")
    assert run(tmp_path) == 0


def test_other_missing_modules_are_faults(tmp_path):
    copied(tmp_path, "llm")
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert run(tmp_path) != 0
