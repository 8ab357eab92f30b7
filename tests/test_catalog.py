import pytest

from strandflow import catalog
from tests.conftest import compare


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    compare(spark, sf_dir, catalog.QUERIES, catalog.ORACLE_SQL, name)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["index", "document_id", "event_type", "seq"]


def test_entry_works_without_the_training_data_subpackage(tmp_path):
    """A copy of the repository without it still offers the other queries."""
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "strandflow", tmp_path / "strandflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.stdout.strip().endswith(str(len(catalog.QUERIES))), out.stderr
