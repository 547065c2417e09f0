"""Every registered query against its SQL on whole tables, and the shape of the registry."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from tests.conftest import SF_SMALL

from listprep.queries import load

QUERIES, SQL = load().QUERIES, load().SQL


@pytest.fixture(scope="module")
def db():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, db, name):
    result = compare(spark, db, SF_SMALL, QUERIES[name], SQL[name])
    assert result.startswith("ok"), result


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_without_the_optional_parts(tmp_path):
    root = Path(entry.__file__).parent
    shutil.copytree(root / "listprep", tmp_path / "listprep", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(SQL))]


def test_entry(spark):
    assert entry.entry(spark).columns == ["link", "page_id", "label"]
