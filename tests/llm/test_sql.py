"""Queries of the package beside their SQL, and the names that must be there."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from listprep.llm import load


@pytest.mark.parametrize("name", sorted(load().SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_rows_as_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(spark, connect(folder), folder, load().QUERIES[name], load().SQL[name]).startswith("ok")


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
