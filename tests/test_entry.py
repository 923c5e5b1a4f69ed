from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_names_of_sql_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_works_without_the_training_data_subpackage(tmp_path):
    """A copy without the subpackage and the pipeline still imports and lists its queries."""
    import shutil

    shutil.copytree(ROOT / "ledgerflow", tmp_path / "ledgerflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'snapshot_diff' in q and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
