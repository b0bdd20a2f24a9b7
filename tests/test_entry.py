"""The entry with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent
SHOW = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len([k for k in q if k.startswith('op') or k == 'pipeline']), len(q), set(s) <= set(q))"


def run(folder, code=SHOW):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def copied(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", "*.md", "*.json"))
    return tmp_path / "r"


def test_entry_without_training_data_operators(tmp_path):
    r = copied(tmp_path)
    shutil.rmtree(r / "dossier" / "llm", ignore_errors=True)
    (r / "corpus_pipeline.py").unlink(missing_ok=True)
    out = run(r).stdout.split()
    assert out[0] == "0" and int(out[1]) > 80 and out[2] == "True"


def test_a_fault_inside_is_not_absence(tmp_path):
    r = copied(tmp_path)
    if (r / "dossier" / "llm").exists():
        (r / "dossier" / "llm" / "queries.py").write_text("import no_such_module\n")
        assert "no_such_module" in run(r).stderr
