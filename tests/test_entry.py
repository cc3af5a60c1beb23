"""The entry module stands without the folders of training-corpus operators."""

import pathlib
import shutil
import subprocess
import sys

REPO = pathlib.Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


def test_core_imports_without_the_other_folders(tmp_path):
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "kindred", tmp_path / "kindred", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    run = lambda: subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()[-3:]
    n, ops, twins = run()
    assert int(n) >= 65 and (ops, twins) == ("False", "True")
    if (REPO / "corpus_pipeline.py").exists():  # it alone, without the subpackage it calls
        shutil.copy(REPO / "corpus_pipeline.py", tmp_path)
        assert run() == [n, ops, twins]
