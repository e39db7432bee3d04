from datetime import datetime

import pytest

from curbflow.config import DEFAULT
from curbflow.operators.shaping import side_by_side
from curbflow.plans import hourly, quality
from curbflow.sources.staging import WEATHER_TYPES


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_zone_performance_keeps_one_sided_and_missing_zones(make_trips, make_warehouse):
    w = make_warehouse(
        make_trips({"DOLocationID": None}, {"PULocationID": None, "DOLocationID": 9}, {"total_amount": -5.0})
    )
    found = {(r["location_id"], r["pickup_trips"], r["dropoff_trips"]): r for r in rows(w.zone_performance)}
    assert set(found) == {(1, 2, 0), (2, 0, 1), (9, 0, 1), (None, 1, 0), (None, 0, 1)}
    assert found[(1, 2, 0)]["pickup_revenue"] == 25.5 and found[(1, 2, 0)]["airport_dropoff_share"] is None
    assert found[(9, 0, 1)]["zone"] is None and found[(9, 0, 1)]["avg_pickup_distance"] is None


def test_payment_codes_and_canonical_types(make_trips, make_warehouse):
    w = make_warehouse(make_trips(*({"payment_type": p} for p in (0, 5, None, 1, 7))))
    by_code = {r["payment_type"]: r["payment_type_label"] for r in rows(w.fare_payment_metrics)}
    assert by_code == {0: "Unknown", 5: "Unknown", None: "Unknown", 1: "Credit Card", 7: "Unknown"}
    marts = {r["payment_type"]: r for r in rows(w.fare_payment_analysis)}
    assert {k: v["trips"] for k, v in marts.items()} == {1: 1, 5: 4}
    assert marts[5]["trip_share_pct"] == 80.0 and marts[1]["median_fare"] == 20.0


def test_airport_category_precedence(make_trips, make_warehouse):
    pairs = [(132, 132), (138, 138), (132, 138), (138, 132), (132, 1), (1, 132), (138, 1), (1, 138), (None, 132), (1, None)]
    w = make_warehouse(make_trips(*({"PULocationID": a, "DOLocationID": b} for a, b in pairs)))
    assert {r["airport_category"]: r["total_trips"] for r in rows(w.airport_metrics)} == {
        "JFK to JFK": 1, "LaGuardia to LaGuardia": 1, "JFK to LaGuardia": 1, "LaGuardia to JFK": 1, "JFK Pickup": 1,
        "JFK Dropoff": 2, "LaGuardia Pickup": 1, "LaGuardia Dropoff": 1, "Non-Airport": 1,
    }


def test_weather_schemes_differ_and_missing_weather_stays_unknown(make_trips, make_warehouse):
    hours = [datetime(2024, 4, 1, h) for h in range(5)]
    weather = [
        (hours[0], 10.0, 50, 1.0, 0.0, 0.0, 1, 5.0, 10),
        (hours[1], 30.0, 50, 5.5, 0.0, 0.0, 1, 5.0, 10),
        (hours[2], 33.0, 50, 0.0, 0.0, 0.0, 1, 5.0, 10),
        (hours[3], None, None, None, None, None, None, None, None),
    ]
    trips = make_trips(*({"tpep_pickup_datetime": h, "tpep_dropoff_datetime": h} for h in hours))
    w = make_warehouse(trips, weather=weather)
    fine = {r["pickup_hour"].hour: r for r in rows(w.weather_mobility_metrics)}
    coarse = {r["pickup_hour"].hour: r for r in rows(w.weather_transit_analysis)}
    assert [fine[h]["precipitation_category"] for h in range(5)] == [
        "Light Rain", "Heavy Rain", "Dry", "Unknown", "Unknown"]
    assert [fine[h]["temperature_category"] for h in range(5)] == ["Cool", "Warm", "Hot", "Unknown", "Unknown"]
    assert [coarse[h]["precipitation_category"] for h in range(5)] == [
        "Light Rain", "Moderate Rain", "Dry", "Unknown", "Unknown"]
    assert [coarse[h]["temperature_category"] for h in range(5)] == ["Mild", "Hot", "Hot", "Hot", "Hot"]
    assert fine[3]["weather_complete"] is False and fine[3]["is_raining"] is None
    flags = {r["pickup_hour"].hour: r["rain_flag"] for r in rows(w.statistical_analysis)}
    assert flags == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0}


def test_peak_hour_tie_takes_the_earlier_hour(make_trips, make_warehouse):
    w = make_warehouse(
        make_trips(*({"tpep_pickup_datetime": datetime(2024, 4, 1, h), "tpep_dropoff_datetime": datetime(2024, 4, 1, h, 30)}
                     for h in (9, 9, 7, 7, 8)))
    )
    r = rows(w.executive_mobility)[0]
    assert (r["peak_hour"], r["peak_hour_trips"], r["total_trips"]) == (7, 2.0, 5)


def test_lags_count_rows_unless_hours_are_filled(make_trips, make_warehouse):
    from curbflow.plans.regression_base import fill_missing_hours, statistical_analysis

    picks = [datetime(2024, 4, 1, 0), datetime(2024, 4, 1, 2)]
    w = make_warehouse(make_trips(*({"tpep_pickup_datetime": h, "tpep_dropoff_datetime": h} for h in picks)))
    lag = {r["pickup_hour"].hour: r["taxi_trip_count_lag_1"] for r in rows(w.statistical_analysis)}
    assert lag == {0: None, 2: 1}
    filled = statistical_analysis(fill_missing_hours(w.hourly_mobility_summary, w.hourly_spine))
    assert filled.count() == DEFAULT.period.hours
    by_hour = {r["pickup_hour"]: r["taxi_trip_count_lag_1"] for r in rows(filled.limit(4).orderBy("pickup_hour"))}
    assert by_hour[picks[1]] == 0


def test_empty_input_gives_empty_marts_and_one_quality_row(make_trips, make_warehouse):
    w = make_warehouse(make_trips({}).limit(0))
    assert w.hourly_mobility_summary.count() == 0 and w.zone_performance.count() == 0
    r = rows(w.data_quality_metrics)[0]
    assert r["total_trips"] == 0 and r["duration_validity_pct"] is None


def test_three_ways_to_the_hourly_summary_agree(small_built):
    w = small_built
    context = w.hourly_context
    rolled = hourly.hourly_mobility_summary(w.hourly_mobility)
    direct = hourly.hourly_summary_from_trips(w.trips_clean, context)
    facts = hourly.hourly_summary_from_demand(w.hourly_taxi_demand, context)

    def table(df):
        return sorted(
            tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in rolled.columns)) for r in df.collect()
        )

    assert table(rolled) == table(direct) == table(facts)


def test_written_layers_keep_columns_and_rows(small_built):
    assert small_built.trips_clean.count() == 6000
    assert small_built.hourly_context.count() == DEFAULT.period.hours
    assert small_built.hourly_mobility.columns[:2] == ["pickup_hour", "pickup_location_id"]
    assert set(WEATHER_TYPES) <= set(small_built.hourly_mobility.columns)
    assert "hourly_taxi_demand" in small_built.written


def test_opened_warehouse_reads_what_was_built(spark, make_trips, make_warehouse, tmp_path):
    from curbflow import Warehouse

    w = make_warehouse(make_trips({}, {"payment_type": 2}))
    built = w.build(str(tmp_path))
    opened = Warehouse.open(spark, w.inputs, str(tmp_path))
    assert rows(opened.executive_mobility) == rows(built.executive_mobility)


def test_anomalies_are_ordered_by_severity_then_rows(small_built):
    order = {"Critical": 1, "High": 2, "Medium": 3, "Low": 4}
    listed = quality.data_quality_anomalies(small_built.trips_clean)
    found = [(order[r["severity"]], -r["affected_rows"], r["issue_id"]) for r in rows(listed)]
    assert len(found) == 16 and found == sorted(found)


def test_side_by_side_folds_one_row_frames(spark):
    a, b = spark.sql("select 1 x, 'p' y"), spark.sql("select cast(null as int) z, true w")
    assert rows(side_by_side(a, b)) == [{"x": 1, "y": "p", "z": None, "w": True}]


@pytest.mark.parametrize("column", ["pickup_zone_completeness_pct", "duration_validity_pct", "weather_completeness_pct"])
def test_quality_percentages_are_bounded(small_built, column):
    assert 0 <= rows(small_built.data_quality_metrics)[0][column] <= 100


def test_small_data_lacks_hours_and_is_marked_for_review(small_built):
    r = rows(small_built.data_quality_metrics)[0]
    assert r["warehouse_quality_status"] == "REVIEW" and r["hourly_rows"] == 1854
