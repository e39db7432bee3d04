import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from curbflow import Warehouse  # noqa: E402
from curbflow.session import build_session  # noqa: E402
from curbflow.sources import fixtures  # noqa: E402
from curbflow.sources.staging import StagedInputs  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

TRIP_SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count bigint, "
    "trip_distance double, RatecodeID bigint, store_and_fwd_flag string, PULocationID int, DOLocationID int, "
    "payment_type bigint, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, Airport_fee double"
)
BASE_TRIP = dict(
    VendorID=1, tpep_pickup_datetime=datetime(2024, 4, 1, 10, 15), tpep_dropoff_datetime=datetime(2024, 4, 1, 10, 45),
    passenger_count=1, trip_distance=5.0, RatecodeID=1, store_and_fwd_flag="N", PULocationID=1, DOLocationID=2,
    payment_type=1, fare_amount=20.0, extra=0.0, mta_tax=0.5, tip_amount=4.0, tolls_amount=0.0,
    improvement_surcharge=1.0, total_amount=25.5, congestion_surcharge=0.0, Airport_fee=0.0,
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_trips(spark):
    """Trips from overrides of one ordinary trip."""

    def make(*overrides: dict):
        rows = [tuple({**BASE_TRIP, **o}.values()) for o in overrides]
        return spark.createDataFrame(rows, TRIP_SCHEMA)

    return make


@pytest.fixture(scope="session")
def make_warehouse(spark, make_trips):
    def make(trips, zones=((1, "A", "Alpha", "Yellow Zone"), (2, "B", "Beta", "Boro Zone")), weather=(), subway=()):
        inputs = StagedInputs(
            taxi_trips=trips,
            taxi_zones=spark.createDataFrame(
                list(zones), "location_id int, borough string, zone string, service_zone string"
            ),
            weather_hourly=spark.createDataFrame(
                list(weather),
                "timestamp_hour timestamp_ntz, temperature_2m double, relative_humidity_2m int, precipitation double, "
                "rain double, snowfall double, weather_code int, wind_speed_10m double, cloud_cover int",
            ),
            subway_hourly=spark.createDataFrame(
                list(subway), "timestamp_hour timestamp_ntz, total_ridership bigint, total_transfers bigint"
            ),
        )
        return Warehouse(spark, inputs)

    return make


@pytest.fixture(scope="session")
def small_built(spark, tmp_path_factory):
    """The whole warehouse on the smallest data, materialised once."""
    warehouse = Warehouse(spark, fixtures.staged(spark, SMALL))
    return warehouse.build(str(tmp_path_factory.mktemp("warehouse")))
