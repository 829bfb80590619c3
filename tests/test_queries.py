"""Every registered query equals its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_point
from rentloom.workload import oracles, queries


@pytest.fixture(scope="module")
def con(smallest):
    return compare.duck(smallest)


@pytest.mark.parametrize("name", sorted(queries.REGISTERED))
def test_query(spark, smallest, con, name):
    assert compare.differences(queries.REGISTERED[name](spark, smallest), con, oracles.SQL[name]) == []


def test_contract(spark):
    assert set(queries.REGISTERED) == set(oracles.SQL)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(queries.REGISTERED) <= set(entry_point.queries())
    assert entry_point.entry(spark).columns[:4] == ["cbsafp", "metro_name", "source", "cat_beds"]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
@pytest.mark.parametrize("name", ["scrape_times", "listing_dates", "listings_per_month", "scan_filter"])
def test_results_do_not_depend_on_the_time_zone(spark, smallest, con, name, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert compare.differences(queries.REGISTERED[name](spark, smallest), con, oracles.SQL[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
