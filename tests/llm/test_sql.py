"""The operators that SQL can express, against their SQL."""

import pytest

from stormledger.llm.queries import QUERIES, SQL
from workload.compare import compare, open_tables


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, name):
    problems, _, _ = compare(spark, open_tables(sf_dir), QUERIES[name], SQL[name], sf_dir)
    assert not problems


def test_names():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
