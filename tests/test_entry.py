"""The entry without the text package, its pipeline or their libraries."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def shown(folder, before=""):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", before + SHOW], cwd=folder, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()[-3:]


def engine_queries():
    from checks.queries import QUERIES

    return [str(len(QUERIES))] * 2 + ["False"]


@pytest.mark.parametrize("hidden", [["llm"], ["corpus_pipeline.py"], ["llm", "corpus_pipeline.py"]])
def test_entry_without_folders(tmp_path, hidden):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda _, names: {".git", "__pycache__", *hidden} & set(names))
    assert not (copy / "hazline" / "llm").exists() or "llm" not in hidden
    got = shown(copy)
    if "llm" in hidden:
        assert got == engine_queries()
    else:
        assert got[2] == "False"


def test_entry_without_libraries():
    block = "import sys; sys.modules['tokenizers'] = sys.modules['public_tokenizers'] = None; "
    assert shown(ROOT, block) == engine_queries()
