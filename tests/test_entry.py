"""The driver contract imports with and without the optional operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
SHOW = """
import __spark_entry__ as e
names = set(e.queries())
assert set(e.oracle_sql()) <= names
print(len([n for n in names if not n.startswith("op") and n != "pipeline"]), "pipeline" in names, any(n.startswith("op") for n in names))
"""


def imported(folder) -> list[str]:
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_imports_without_the_optional_operators(tmp_path, with_pipeline):
    shutil.copytree(REPO / "harmlens", tmp_path / "harmlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    if with_pipeline and (REPO / "corpus_pipeline.py").exists():
        shutil.copy(REPO / "corpus_pipeline.py", tmp_path)
    (tmp_path / "harmlens/llm/__pycache__").mkdir(parents=True)  # what a deleted folder may leave
    n, pipeline, optional = imported(tmp_path)
    assert (pipeline, optional) == ("False", "False")
    assert n == imported(REPO)[0] and int(n) >= 229
