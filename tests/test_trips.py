from datetime import datetime, timedelta

from curbflow.plans.trips import RENAMES, taxi_trips_clean, trip_metrics

T = datetime(2024, 4, 7, 23, 59, 0, 900_000)  # a Sunday


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_calendar_columns_and_second_boundaries(make_trips):
    r = one(taxi_trips_clean(make_trips({"tpep_pickup_datetime": T, "tpep_dropoff_datetime": T + timedelta(seconds=1.2)})))
    assert r.pickup_hour == datetime(2024, 4, 7, 23)
    assert (r.pickup_hour_of_day, r.pickup_day_of_week) == (23, 0)
    assert r.pickup_week == datetime(2024, 4, 1)
    assert r.pickup_month == datetime(2024, 4, 1)
    # 0.9 s to 2.1 s crosses two second boundaries although only 1.2 s elapse
    assert r.duration_seconds == 2


def test_hours_do_not_shift_with_the_session_zone(spark, make_trips):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        gap = datetime(2024, 3, 10, 2, 30)  # skipped by daylight saving in that zone
        r = one(taxi_trips_clean(make_trips({"tpep_pickup_datetime": gap, "tpep_dropoff_datetime": gap + timedelta(hours=1)})))
        assert r.pickup_hour == datetime(2024, 3, 10, 2)
        assert r.duration_seconds == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_values_keep_three_valued_flags(make_trips):
    r = one(
        taxi_trips_clean(
            make_trips(
                {"tpep_dropoff_datetime": None, "trip_distance": None, "total_amount": None, "fare_amount": None,
                 "passenger_count": None, "PULocationID": None, "DOLocationID": None, "payment_type": None}
            )
        )
    )
    assert r.is_missing_dropoff_datetime and r.is_negative_duration is None and r.is_long_duration is None
    assert r.is_duration_valid is False
    assert r.is_missing_distance and r.is_zero_distance is None and r.is_distance_valid is False
    assert r.is_revenue_valid is False and r.is_negative_total is None
    assert r.is_passenger_valid is False and r.is_unknown_passenger
    assert r.is_unknown_payment is None and r.payment_type_label == "Unknown"
    assert r.is_missing_pickup_zone and r.is_missing_dropoff_zone
    assert (r.duration_quality, r.distance_quality, r.revenue_quality) == (
        "Valid Duration", "Valid Distance", "Valid Revenue")


def test_thresholds(make_trips):
    start = datetime(2024, 4, 1)
    df = taxi_trips_clean(
        make_trips(
            {"VendorID": 1, "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + timedelta(days=1)},
            {"VendorID": 2, "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + timedelta(days=1, seconds=1)},
            {"VendorID": 3, "trip_distance": 100.0, "passenger_count": 6},
            {"VendorID": 4, "trip_distance": 100.1, "passenger_count": 7},
            {"VendorID": 5, "trip_distance": -1.0, "passenger_count": -1, "payment_type": 0},
            {"VendorID": 6, "total_amount": 0.0, "fare_amount": 0.0, "payment_type": 5},
            {"VendorID": 7, "total_amount": -3.0, "fare_amount": -2.0, "payment_type": 9},
        )
    )
    r = {row.vendor_id: row for row in df.collect()}
    assert not r[1].is_long_duration and r[1].is_duration_valid
    assert r[2].is_long_duration and not r[2].is_duration_valid and r[2].duration_quality == "Over 24 Hours"
    assert not r[3].is_extreme_distance and not r[3].is_high_passenger_count
    assert r[4].is_extreme_distance and not r[4].is_distance_valid
    assert r[4].is_high_passenger_count and r[4].is_passenger_valid
    assert r[5].is_negative_distance and r[5].is_passenger_valid and r[5].is_unknown_payment
    assert r[6].is_zero_total and r[6].is_revenue_valid and not r[6].is_unknown_payment
    assert {r[v].payment_type_label for v in (5, 6, 7)} == {"Unknown"}
    assert r[7].revenue_quality == "Negative Total" and r[7].is_negative_fare


def test_no_row_is_dropped_and_names_follow_the_table(make_trips):
    trips = make_trips({}, {}, {"tpep_pickup_datetime": None})
    clean = taxi_trips_clean(trips)
    assert clean.count() == 3
    assert clean.columns[: len(RENAMES)] == list(RENAMES.values())


def test_metrics_are_null_without_valid_inputs(make_trips):
    start = datetime(2024, 4, 1)
    df = trip_metrics(
        taxi_trips_clean(
            make_trips(
                {"VendorID": 1, "tpep_dropoff_datetime": datetime(2024, 4, 1, 10, 16, 30, 500_000)},
                {"VendorID": 2, "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start},
                {"VendorID": 3, "trip_distance": 0.0, "tip_amount": None},
                {"VendorID": 4, "total_amount": -1.0},
                {"VendorID": 5, "fare_amount": 0.0, "tip_amount": -1.0},
                {"VendorID": 6, "PULocationID": 132, "DOLocationID": 138},
                {"VendorID": 7, "PULocationID": None, "DOLocationID": 138},
            )
        )
    )
    r = {row.vendor_id: row for row in df.collect()}
    assert abs(r[1].trip_duration_minutes - 90.5 / 60) < 1e-12
    assert abs(r[1].trip_speed_mph - 5.0 / (90.5 / 3600)) < 1e-9
    assert r[2].is_duration_valid and r[2].trip_duration_minutes is None and not r[2].has_positive_duration
    assert r[3].fare_per_mile is None and r[3].trip_speed_mph is None and r[3].is_tipped is False
    assert r[4].fare_per_mile is None and r[4].total_amount_per_minute is None and not r[4].is_positive_revenue_trip
    assert r[5].tip_percentage is None and r[5].is_tipped is False
    assert r[6].airport_trip_type == "Airport to Airport"
    assert r[7].airport_trip_type == "Airport Dropoff" and r[7].is_airport_pickup is False
