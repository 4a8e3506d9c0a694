"""The entry point works without the training-data subpackage and the pipeline."""
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys; sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
q, s = e.queries(), e.oracle_sql()
assert set(s) <= set(q) and "q1_top_countries" in q, sorted(q)[:5]
print(sum(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in q), len(q))
"""


def _names(root) -> tuple[int, int]:
    out = subprocess.run([sys.executable, "-B", "-c", CODE, str(root)], capture_output=True, text=True, cwd=root, check=True)
    return tuple(map(int, out.stdout.split()[-2:]))


def test_without_training_data_parts(tmp_path):
    whole = tmp_path / "repo"
    shutil.copytree(ROOT, whole, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    training, others = _names(whole)
    assert training == 0 and others > 70
