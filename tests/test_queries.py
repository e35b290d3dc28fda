"""Every registered query against its SQL, at the smallest scale."""

import pytest

from workload.compare import compare, open_tables
from workload.oracles import SQL
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_tables(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    problems, _, _ = compare(spark, con, QUERIES[name], SQL[name], sf_dir)
    assert not problems


@pytest.mark.parametrize("name", ["q_block_join", "q_track_ids", "q_landfall_ids", "q_fact_join"])
def test_query_without_help_from_the_planner(spark, con, sf_dir, name):
    """Shuffle joins, no adaptive execution, no ANSI mode: same results."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.ansi.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        problems, _, _ = compare(spark, con, QUERIES[name], SQL[name], sf_dir)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert not problems
