import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracles import compare, duck

# A spread over the query families; tools/check_oracles.py runs all of them.
CHECKED = (
    "taxi_trips_clean", "hourly_mobility_summary", "hourly_context", "zone_performance", "fare_payment_analysis",
    "weather_transit_analysis", "statistical_analysis", "data_quality_metrics", "anomaly_kpi_impact",
    "profile_event_steps", "validate_duplicate_orders", "metric_percentiles",
)


@pytest.fixture(scope="module")
def database():
    return duck(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_statement(spark, database, name):
    assert compare(entry.queries()[name](spark, SMALL), database, entry.oracle_sql()[name]) == []


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 5
