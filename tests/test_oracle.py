"""Every registered query with oracle SQL equals DuckDB on the same tables."""

import pytest

from tests.conftest import SF001
from tests.oracle_harness import compare, duck
from tidemark.plans.registry import oracle_sql, queries

_SQL = oracle_sql()
_Q = queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(_SQL))
def test_matches_oracle(spark, con, name):
    assert compare(spark, con, name, _Q[name], _SQL[name], SF001, verbose=True)


def test_every_oracle_has_a_query():
    assert set(_SQL) <= set(_Q)


@pytest.mark.parametrize("name", ["churn_user_bins", "host_state", "cohort_hourly_rates", "stream_window_counts"])
def test_session_zone_does_not_matter(spark, con, name):
    """Event times are TIMESTAMP_NTZ; every conversion is zone-free, so a
    non-UTC session gives the same answers."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, con, name, _Q[name], _SQL[name], SF001, verbose=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
