"""Every query of the library against its SQL, and the flagship entry."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import query_set
from compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = query_set.QUERIES, query_set.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], FOLDER) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "customer_key" and df.columns[-1] == "churn_risk"
    assert df.count() > 0


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",)])
def test_the_library_works_without_its_training_data_part(tmp_path, left):
    root = Path(entry_points.__file__).parent
    shutil.copytree(root / "basketry", tmp_path / "basketry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "query_set.py", "oracle.py", *(n for n in left if (root / n).exists())):
        shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert told.stdout.split() == sorted(QUERIES)
