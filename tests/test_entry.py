"""The entry file works without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_optional_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "pitwall", tmp_path / "pitwall", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    queries, sql, pipeline = done.stdout.split()
    assert int(queries) > 161 and int(sql) > 150 and pipeline == "False"
