"""Oracle statements of the analyses, profiles and validation jobs."""

from __future__ import annotations

from oracles.base import compose
from oracles.relations import DATA_QUALITY, TEMPORAL, WEATHER_METRICS

_WINDOWS = "(values ('14:00-18:00', 14, 18), ('15:00-19:00', 15, 19), ('16:00-20:00', 16, 20)) as w(window_name, start_hour, end_hour)"

GIVEN_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
)

# Columns and types of the staged trips and the hourly ridership.
TRIP_TYPES = {
    "VendorID": "int", "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint", "trip_distance": "double", "RatecodeID": "bigint", "store_and_fwd_flag": "string",
    "PULocationID": "int", "DOLocationID": "int", "payment_type": "bigint", "fare_amount": "double", "extra": "double",
    "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double", "improvement_surcharge": "double",
    "total_amount": "double", "congestion_surcharge": "double", "Airport_fee": "double",
}
SUBWAY_TYPES = {"timestamp_hour": "timestamp_ntz", "total_ridership": "bigint", "total_transfers": "bigint"}
WEATHER_TYPES = {
    "timestamp_hour": "timestamp_ntz", "temperature_2m": "double", "relative_humidity_2m": "int", "precipitation": "double",
    "rain": "double", "snowfall": "double", "weather_code": "int", "wind_speed_10m": "double", "cloud_cover": "int",
}
ZONE_TYPES = {"location_id": "int", "borough": "string", "zone": "string", "service_zone": "string"}
BOUNDED_PERCENTAGES = (
    "pickup_zone_completeness_pct", "dropoff_zone_completeness_pct", "duration_validity_pct", "distance_validity_pct",
    "revenue_validity_pct", "passenger_validity_pct", "weather_completeness_pct", "subway_completeness_pct",
)

ANALYSIS_SQL = {
    "recommendation_sensitivity": compose(
        f"""select window_name, start_hour, end_hour, count(*) filter (inside) as window_hours,
              avg(n) filter (inside) as peak_window_avg_hourly_trips,
              avg(n) filter (not inside) as outside_window_avg_hourly_trips,
              (sum(n) filter (inside))::bigint as window_total_trips,
              (avg(n) filter (inside) / avg(n) filter (not inside) - 1) * 100 as demand_lift_pct
            from (select w.*, taxi_trip_count as n, hour_of_day between start_hour and end_hour - 1 as inside
                  from m_summary, {_WINDOWS}) group by 1, 2, 3""",
        "peak_window_avg_hourly_trips outside_window_avg_hourly_trips demand_lift_pct",
    ),
    "anomaly_kpi_impact": compose(
        """select p.population, count(*) as total_trips, sum(total_amount) as total_revenue,
             avg(total_amount) as avg_amount_per_trip,
             100.0 * count(*) / (select count(*) from m_metrics) as trip_retention_pct,
             100.0 * sum(total_amount) / (select sum(total_amount) from m_metrics) as revenue_retention_pct
           from m_metrics m join (values ('All trips'), ('Quality-valid trips')) as p(population)
             on p.population = 'All trips'
             or (is_duration_valid and is_distance_valid and is_revenue_valid and is_passenger_valid)
           group by 1""",
        "total_revenue avg_amount_per_trip trip_retention_pct revenue_retention_pct",
    ),
    "weekday_weekend": compose(
        """select if(is_weekend, 'Weekend', 'Weekday') as day_type, count(*) as hours,
             round(avg(taxi_trip_count), 2) as avg_taxi_trips, median(taxi_trip_count) as median_taxi_trips,
             round(avg(subway_ridership), 2) as avg_subway_ridership from m_summary group by is_weekend""",
        "avg_taxi_trips median_taxi_trips avg_subway_ridership",
    ),
    "weather_impact": compose(
        """select case when precipitation = 0 then 'Dry' when precipitation <= 1 then 'Light rain'
                when precipitation <= 5 then 'Moderate rain' else 'Heavy rain' end as precipitation_category,
             count(*) as hours, round(avg(taxi_trip_count), 2) as avg_taxi_trips,
             median(taxi_trip_count) as median_taxi_trips from m_summary group by 1""",
        "avg_taxi_trips median_taxi_trips",
    ),
    "top_pickup_zones": compose(
        """select pickup_location_id, pickup_zone, pickup_borough, sum(trip_count)::bigint as trips
           from m_mobility group by 1, 2, 3 order by trips desc, pickup_location_id limit 20"""
    ),
    "top_od_pairs": compose(
        """select pickup_zone, dropoff_zone, sum(trip_count)::bigint as trips
           from m_mobility group by 1, 2 order by trips desc, 1, 2 limit 20"""
    ),
    "hourly_pattern": compose(
        """select hour_of_day, count(*) as observations, round_even(avg(taxi_trip_count), 2) as avg_taxi_trips,
             round_even(median(taxi_trip_count), 2) as median_taxi_trips from m_summary group by 1""",
        "avg_taxi_trips median_taxi_trips",
    ),
    "peak_and_trough": compose(
        """with h as (select hour_of_day as h, round_even(avg(taxi_trip_count), 2) as a from m_summary group by 1)
           select p.h as peak_hour, p.a as peak_avg_trips, t.h as trough_hour, t.a as trough_avg_trips
           from (from h order by a desc, h limit 1) p, (from h order by a, h limit 1) t""",
        "peak_avg_trips trough_avg_trips",
    ),
    "weather_conditions": compose(
        """select case when precipitation > 0 then 'precipitation' when rain > 0 then 'rain' else 'dry' end
             as weather_condition, count(*) as hours, round_even(avg(taxi_trip_count), 2) as avg_taxi_trips,
             round_even(median(taxi_trip_count), 2) as median_taxi_trips,
             round_even(avg(precipitation), 3) as avg_precipitation from m_summary group by 1""",
        "avg_taxi_trips median_taxi_trips avg_precipitation",
    ),
    "result_through_csv": compose(
        """select case when precipitation > 0 then 'precipitation' when rain > 0 then 'rain' else 'dry' end
             as weather_condition, count(*) as hours, round_even(avg(taxi_trip_count), 2) as avg_taxi_trips,
             round_even(median(taxi_trip_count), 2) as median_taxi_trips,
             round_even(avg(precipitation), 3) as avg_precipitation from m_summary group by 1""",
        "avg_taxi_trips median_taxi_trips avg_precipitation",
    ),
    "demand_distribution": compose(
        """select count(taxi_trip_count) as count, avg(taxi_trip_count) as mean, stddev_samp(taxi_trip_count) as std,
             min(taxi_trip_count)::double as min, quantile_cont(taxi_trip_count, 0.25) as p25,
             quantile_cont(taxi_trip_count, 0.5) as p50, quantile_cont(taxi_trip_count, 0.75) as p75,
             max(taxi_trip_count)::double as max, skewness(taxi_trip_count) as skewness,
             stddev_samp(taxi_trip_count) / avg(taxi_trip_count) as coefficient_of_variation from m_summary""",
        "mean std p25 p50 p75 skewness coefficient_of_variation",
    ),
    "payment_analysis_raw": compose(
        """select payment_type, count(*) as trips, sum(m.total_amount) as total_amount,
             avg(m.total_amount) as avg_amount, median(m.total_amount) as median_amount,
             avg(tip_percentage) as avg_tip_percentage from m_metrics m group by 1""",
        "total_amount avg_amount median_amount avg_tip_percentage",
    ),
    "geographic_analysis_raw": compose(
        """select pickup_location_id as location_id, count(*) as pickup_trips, sum(total_amount) as pickup_revenue,
             avg(trip_distance) as avg_pickup_distance, avg(trip_duration_minutes) as avg_pickup_duration_minutes
           from m_metrics group by 1""",
        "pickup_revenue avg_pickup_distance avg_pickup_duration_minutes",
    ),
    "pilot_sample_size": compose(
        """select airport_trip_type, count(*) as observations, avg(n) as baseline_mean, stddev_samp(n) as baseline_sd,
             avg(n) * 0.05 as effect,
             ceil(2 * pow(1.959963984540054 + 0.8416212335729143, 2) * var_samp(n) / pow(avg(n) * 0.05, 2))::bigint
               as units_per_arm
           from (select airport_trip_type, date_trunc('hour', pickup_datetime) as h, count(*) as n
                 from m_metrics where is_airport_trip group by 1, 2) group by 1""",
        "baseline_mean baseline_sd effect",
    ),
    "temporal_filtered_summary": compose(
        """select hour_of_day, round_even(avg(taxi_trip_count), 0) as avg_trips,
             sum(taxi_trip_count)::bigint as total_trips, count(*) as observations
           from m_summary where hour_of_day between 6 and 20
             and calendar_date > (select max(calendar_date) from m_summary) - 30 group by 1""",
        "avg_trips",
    ),
    "temporal_extremes": compose(
        """with h as (select hour_of_day as h, avg(taxi_trip_count) as a from m_summary
                      where calendar_date > (select max(calendar_date) from m_summary) - 90 group by 1)
           select p.h as peak_hour, p.a as peak_demand, l.h as low_hour, l.a as low_demand,
             (p.a / l.a - 1) * 100 as demand_gap_pct
           from (from h order by a desc, h limit 1) p, (from h order by a, h desc limit 1) l""",
        "peak_demand low_demand demand_gap_pct",
    ),
    "geography_top_zones": compose(
        """select location_id, zone, service_zone, total_zone_activity, total_zone_revenue,
             revenue_per_zone_activity, zone_activity_contribution_pct, zone_revenue_contribution_pct,
             activity_rank, revenue_rank, activity_segment
           from m_geo order by total_zone_activity desc, location_id limit 15""",
        "total_zone_revenue revenue_per_zone_activity zone_activity_contribution_pct zone_revenue_contribution_pct",
    ),
    "geography_low_activity": compose(
        """select location_id, zone, service_zone, total_zone_activity, total_zone_revenue,
             zone_activity_contribution_pct, zone_revenue_contribution_pct, activity_segment
           from m_geo where below_median_activity_indicator""",
        "total_zone_revenue zone_activity_contribution_pct zone_revenue_contribution_pct",
    ),
    "geography_kpis": compose(
        """with v as (select * from m_geo where service_zone = 'Boro Zone')
           select (select zone from v order by total_zone_activity desc, location_id limit 1) as top_activity_zone,
             (select max(total_zone_activity) from v) as top_activity,
             (select zone from v order by total_zone_revenue desc, location_id limit 1) as top_revenue_zone,
             (select max(total_zone_revenue) from v) as top_revenue,
             (select count(*) from v where below_median_activity_indicator) as low_activity_zones,
             (select sum(s) from (select zone_activity_contribution_pct as s from v
                order by total_zone_activity desc, location_id limit 10)) as top_10_activity_share_pct""",
        "top_revenue top_10_activity_share_pct",
    ),
    "geography_borough_view": compose(
        "select g.*, z.borough from m_geo g join m_zones z using (location_id) where z.borough = 'ASIA'",
        "pickup_revenue dropoff_revenue avg_pickup_duration_minutes avg_pickup_distance avg_fare_per_mile "
        "total_zone_revenue revenue_per_zone_activity airport_pickup_share airport_dropoff_share "
        "activity_percentile zone_activity_contribution_pct zone_revenue_contribution_pct",
    ),
    "revenue_by_payment_label": compose(
        """select payment_type_label, sum(p.total_amount) as total_amount, count(*) > 1 as is_duplicate_label
           from m_pay_mart p group by 1""",
        "total_amount",
    ),
    "payment_leader": compose(
        """select payment_type_label, amount_share_pct, trip_share_pct from m_pay_mart
           order by amount_share_pct desc limit 1""",
        "amount_share_pct trip_share_pct",
    ),
    "weather_evidence": compose(
        """with v as (select precipitation_category, count(*) as hours,
                        any_value(category_avg_taxi_trips) as category_avg_taxi_trips
                      from m_weather_transit where calendar_date between '2024-04-15' and '2024-06-15' group by 1)
           select *, (category_avg_taxi_trips / (select category_avg_taxi_trips from v
                      where precipitation_category = 'Dry') - 1) * 100 as vs_dry_pct from v""",
        "category_avg_taxi_trips vs_dry_pct",
    ),
    "weather_evidence_of_a_category": compose(
        """select precipitation_category, count(*) as hours, any_value(category_avg_taxi_trips) as category_avg_taxi_trips,
             0::double as vs_dry_pct
           from m_weather_transit where precipitation_category = 'Dry' and calendar_date between '2024-04-15' and '2024-06-15'
           group by 1""",
        "category_avg_taxi_trips vs_dry_pct",
    ),
    "map_values_revenue": compose(
        """select location_id, least(greatest(total_zone_revenue,
               (select quantile_cont(total_zone_revenue, 0.02) from m_geo where total_zone_revenue > 0)),
               (select quantile_cont(total_zone_revenue, 0.98) from m_geo where total_zone_revenue > 0)) as map_value
           from m_geo""",
        "map_value",
    ),
    "map_values_low_activity": compose(
        "select location_id, below_median_activity_indicator::int::double as map_value from m_geo", "map_value"
    ),
    "metric_percentiles": compose(
        "select "
        + ", ".join(
            f"quantile_cont({m}, {q}) filter ({cond}) as {m}_{p}"
            for m, cond in {
                "total_amount": "is_revenue_valid",
                "trip_distance": "is_distance_valid",
                "trip_duration_minutes": "true",
            }.items()
            for p, q in {"p90": 0.90, "p95": 0.95, "p99": 0.99}.items()
        )
        + " from m_metrics",
        " ".join(f"{m}_{p}" for m in ("total_amount", "trip_distance", "trip_duration_minutes") for p in ("p90", "p95", "p99")),
    ),
    "tip_percentiles": compose(
        """select if(payment_type between 1 and 4, payment_type, 5) as payment_type,
             quantile_cont(tip_amount, 0.5) as tip_p50, quantile_cont(tip_amount, 0.9) as tip_p90,
             quantile_cont(tip_amount, 0.95) as tip_p95, quantile_cont(tip_amount, 0.99) as tip_p99
           from m_metrics where is_revenue_valid group by 1""",
        "tip_p50 tip_p90 tip_p95 tip_p99",
    ),
    "valid_medians": compose(
        """select median(case when is_distance_valid then trip_distance end) as median_valid_distance,
             median(trip_duration_minutes) as median_valid_minutes from m_metrics""",
        "median_valid_distance median_valid_minutes",
    ),
    "valid_payment_metrics": compose(
        """select if(payment_type between 1 and 4, payment_type, 5) as payment_type, count(*) as valid_trips,
             median(fare_amount) as median_valid_fare, avg(tip_amount) as avg_valid_tip
           from m_metrics where is_revenue_valid group by 1""",
        "median_valid_fare avg_valid_tip",
    ),
    "top_hour_concentration": compose(
        """select is_weekend, sum(n)::bigint as total_trips, (sum(n) filter (place <= 5))::bigint as top_trips,
             100.0 * sum(n) filter (place <= 5) / sum(n) as top_hour_share_pct
           from (select is_weekend, hour_of_day, sum(taxi_trip_count) as n,
                   row_number() over (partition by is_weekend order by sum(taxi_trip_count) desc, hour_of_day) as place
                 from m_summary group by 1, 2) group by 1""",
        "top_hour_share_pct",
    ),
    "peak_window_share": compose(
        """select (sum(taxi_trip_count) filter (hour_of_day in (16, 17, 18, 19)))::bigint as window_trips,
             sum(taxi_trip_count)::bigint as total_trips,
             100.0 * sum(taxi_trip_count) filter (hour_of_day in (16, 17, 18, 19)) / sum(taxi_trip_count)
               as window_share_pct from m_summary""",
        "window_share_pct",
    ),
    "taxi_subway_correlation": compose(
        """select count(*) as hours, corr(taxi_trip_count, subway_ridership) as raw_correlation
           from m_summary where subway_ridership is not null""",
        "raw_correlation",
    ),
    "airport_peak_stability": compose(
        """select airport_trip_type, count(*) as days, count(*) filter (h >= 15 and h < 20) as days_in_window,
             100.0 * count(*) filter (h >= 15 and h < 20) / count(*) as stability_pct
           from (select airport_trip_type, pickup_datetime::date as d, hour(pickup_datetime) as h, count(*) as n,
                   row_number() over (partition by airport_trip_type, pickup_datetime::date
                                      order by count(*) desc, hour(pickup_datetime)) as place
                 from m_metrics where is_airport_trip group by 1, 2, 3) where place = 1 group by 1""",
        "stability_pct",
    ),
    "airport_revenue_per_trip": compose(
        """select airport_trip_type, hour(pickup_datetime)::int as hour_of_day, count(*) as airport_trips,
             sum(total_amount) filter (is_revenue_valid) as airport_revenue,
             count(*) filter (is_revenue_valid) as valid_trips,
             avg(total_amount) filter (is_revenue_valid) as revenue_per_trip
           from m_metrics where is_airport_trip group by 1, 2""",
        "airport_revenue revenue_per_trip",
    ),
    "hour_volatility": compose(
        """select is_weekend, hour_of_day, count(*) as hours, avg(taxi_trip_count) as avg_trips,
             stddev_samp(taxi_trip_count) as hourly_sd,
             100.0 * stddev_samp(taxi_trip_count) / avg(taxi_trip_count) as cv_pct from m_summary group by 1, 2""",
        "avg_trips hourly_sd cv_pct",
    ),
}

_SECONDS = "datediff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"
_NEG, _ZERO, _LONG = (
    "tpep_dropoff_datetime < tpep_pickup_datetime", "tpep_dropoff_datetime = tpep_pickup_datetime", f"{_SECONDS} > 86400",
)


def _subset(name: str, condition: str) -> str:
    counts = {
        "payment_unknown": "payment_type = 0", "passenger_unknown": "passenger_count is null",
        "negative_fare": "fare_amount < 0", "negative_total": "total_amount < 0",
        "negative_duration": _NEG, "zero_duration": _ZERO, "zero_distance": "trip_distance = 0",
        "over_100_mile": "trip_distance > 100",
    }
    listed = ", ".join(f"count(*) filter ({c}) as {n}" for n, c in counts.items())
    return f"""select '{name}' as subset, count(*) as trips, {listed}, round(avg(fare_amount), 2) as avg_fare,
        round(avg(t.total_amount), 2) as avg_total, round(avg(trip_distance), 2) as avg_distance,
        round(sum(t.total_amount), 2) as total_amount from m_trips t where {condition}"""


def _mix(table: str, column: str) -> str:
    return compose(
        f"""select {column}, count(*) as trip_count,
            round(100.0 * count(*) / (select count(*) from {table}), 3) as pct_of_trips from {table} group by 1""",
        "pct_of_trips",
    )


def _column(table: str, name: str, kind: str) -> str:
    numeric = kind in ("int", "bigint", "double")
    zero = f"count(*) filter ({name} = 0)" if numeric else "null::bigint"
    mean = f"avg({name}::double)" if numeric else "null::double"
    return f"""select '{name}' as column_name, '{kind}' as data_type, count(*) as row_count,
        count(*) - count({name}) as null_count, min({name})::varchar as min_value, max({name})::varchar as max_value,
        {zero} as zero_count, {mean} as mean_value from {table}"""


def _steps(points: str) -> str:
    return compose(
        f"""select epoch(t - p)::double as step_seconds, count(*) as occurrences
            from (select t, lag(t) over (order by t) as p from ({points})) where p is not null group by 1""",
        "step_seconds",
    )


_RECORD = (
    "tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, fare_amount, total_amount, passenger_count, "
    "PULocationID, DOLocationID, payment_type, VendorID"
)
_NULLS_FIRST = ", ".join(f"{c.strip()} nulls first" for c in _RECORD.split(","))
_TIMED = (
    f"tpep_pickup_datetime, tpep_dropoff_datetime, {_SECONDS} as duration_seconds, trip_distance, fare_amount, "
    "total_amount, passenger_count, payment_type"
)

PROFILE_SQL = {
    "profile_period_counts": compose(
        """select count(*) as total_source_rows, count(*) filter (year(o_orderdate) = 1994) as in_scope_rows,
             count(*) filter (year(o_orderdate) <> 1994) as out_of_scope_rows from orders"""
    ),
    "profile_trip_period_counts": compose(
        """select count(*) as total_source_rows,
             count(*) filter (tpep_pickup_datetime between '2024-04-15' and '2024-05-31 23:59:59.999999') as in_scope_rows,
             count(*) filter (tpep_pickup_datetime not between '2024-04-15' and '2024-05-31 23:59:59.999999') as out_of_scope_rows
           from m_trips"""
    ),
    "profile_temporal_validity": compose(
        f"""select count(*) as total_rows, count(*) filter ({_NEG}) as negative_duration_rows,
              count(*) filter ({_ZERO}) as zero_duration_rows, count(*) filter ({_LONG}) as duration_over_24h,
              0::bigint as impossible_overlap from m_trips"""
    ),
    "profile_distance": compose(
        """select count(*) as total_rows, sum(trip_distance) as total_distance,
             count(*) filter (trip_distance = 0) as zero_distance,
             sum(trip_distance) filter (trip_distance = 0) as zero_distance_amount,
             count(*) filter (trip_distance < 0) as negative_distance,
             count(*) filter (trip_distance > 100) as distance_over_100_miles,
             sum(trip_distance) filter (trip_distance > 100) as over_100_mile_distance,
             count(*) filter (trip_distance > 500) as distance_over_500_miles,
             sum(trip_distance) filter (trip_distance > 500) as over_500_mile_distance,
             max(trip_distance) as max_distance from m_trips""",
        "total_distance zero_distance_amount over_100_mile_distance over_500_mile_distance max_distance",
    ),
    "profile_fares": compose(
        """select count(*) as total_rows, sum(fare_amount) as gross_fare_amount, sum(total_amount) as gross_total_amount,
             count(*) filter (fare_amount < 0) as negative_fare,
             sum(fare_amount) filter (fare_amount < 0) as negative_fare_value,
             count(*) filter (fare_amount = 0) as zero_fare,
             sum(total_amount) filter (fare_amount = 0) as zero_fare_total_value,
             count(*) filter (total_amount < 0) as negative_total,
             sum(total_amount) filter (total_amount < 0) as negative_total_value,
             count(*) filter (total_amount = 0) as zero_total, min(fare_amount) as min_fare,
             max(fare_amount) as max_fare, min(total_amount) as min_total, max(total_amount) as max_total,
             round(100.0 * abs(sum(total_amount) filter (total_amount < 0)) / sum(total_amount), 3)
               as negative_total_pct_of_gross from m_trips""",
        "gross_fare_amount gross_total_amount negative_fare_value zero_fare_total_value negative_total_value min_fare "
        "max_fare min_total max_total negative_total_pct_of_gross",
    ),
    "profile_passengers": compose(
        """select count(*) as total_rows, count(*) filter (passenger_count is null) as null_passengers,
             count(*) filter (passenger_count = 0) as zero_passengers,
             count(*) filter (passenger_count < 0) as negative_passengers,
             count(*) filter (passenger_count > 6) as passengers_over_6, min(passenger_count) as min_passengers,
             max(passenger_count) as max_passengers, avg(passenger_count) as avg_non_null_passengers,
             sum(total_amount) filter (passenger_count is null) as revenue_null_passenger,
             sum(total_amount) filter (passenger_count = 0) as revenue_zero_passenger from m_trips""",
        "avg_non_null_passengers revenue_null_passenger revenue_zero_passenger",
    ),
    "profile_payment_mix": _mix("m_trips", "payment_type"),
    "profile_vendor_mix": _mix("m_trips", "VendorID"),
    "profile_service_zones": _mix("m_zones", "service_zone"),
    "profile_zone_validity": compose(
        """select count(*) as total_rows,
             count(*) filter (not coalesce(PULocationID in (select location_id from m_zones), false)) as invalid_pickup_zone,
             count(*) filter (not coalesce(DOLocationID in (select location_id from m_zones), false)) as invalid_dropoff_zone
           from m_trips"""
    ),
    "profile_unknown_overlap": compose(
        """select count(*) filter (passenger_count is null) as null_passenger,
             count(*) filter (payment_type = 0) as payment_type_zero,
             count(*) filter (passenger_count is null and payment_type = 0) as both,
             sum(total_amount) filter (passenger_count is null and payment_type = 0) as total_amount_both
           from m_trips""",
        "total_amount_both",
    ),
    "profile_exact_duplicates": compose(
        """select coalesce(sum(n), 0)::bigint as duplicate_rows
           from (select t, count(*) as n from m_trips t group by t having count(*) > 1)"""
    ),
    "profile_extreme_distances": compose(
        f"""select {_RECORD} from m_trips where trip_distance > 500
            order by trip_distance desc, {_NULLS_FIRST} limit 20""",
        "trip_distance fare_amount total_amount",
    ),
    "profile_negative_amounts": compose(
        f"""select {_RECORD} from m_trips where fare_amount < 0 or total_amount < 0
            order by total_amount, {_NULLS_FIRST} limit 20""",
        "trip_distance fare_amount total_amount",
    ),
    "profile_invalid_times": compose(
        f"""select {_TIMED} from m_trips where {_NEG} or {_LONG}
            order by duration_seconds, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance nulls first,
              fare_amount, total_amount, passenger_count nulls first, payment_type limit 30""",
        "trip_distance fare_amount total_amount",
    ),
    "profile_distance_by_unknowns": compose(
        """select case when trip_distance > 500 then '>500 miles' when trip_distance > 100 then '100-500 miles'
                when trip_distance > 50 then '50-100 miles' else '<=50 miles' end as distance_bucket,
             count(*) as trips, count(*) filter (payment_type = 0) as payment_unknown,
             count(*) filter (passenger_count is null) as passenger_unknown,
             count(*) filter (payment_type = 0 and passenger_count is null) as both_unknown,
             round(avg(trip_distance), 2) as avg_distance, round(sum(t.total_amount), 2) as total_amount
           from m_trips t group by 1""",
        "avg_distance total_amount",
    ),
    "profile_anomaly_subsets": compose(
        " union all ".join(
            (_subset("zero_distance", "trip_distance = 0"), _subset("over_24h", _LONG), _subset("negative_duration", _NEG))
        ),
        "avg_fare avg_total avg_distance total_amount",
    ),
    "profile_monthly_counts": compose(
        """select date_trunc('month', tpep_pickup_datetime)::timestamp as pickup_month, count(*) as row_count
           from m_trips group by 1"""
    ),
    "profile_source_summary": compose(
        """select count(*) as total_rows, min(tpep_pickup_datetime) as min_pickup, max(tpep_pickup_datetime) as max_pickup,
             min(tpep_dropoff_datetime) as min_dropoff, max(tpep_dropoff_datetime) as max_dropoff,
             count(*) - count(tpep_pickup_datetime) as null_pickup, count(*) - count(tpep_dropoff_datetime) as null_dropoff,
             count(*) - count(PULocationID) as null_pickup_zone, count(*) - count(DOLocationID) as null_dropoff_zone,
             count(*) - count(passenger_count) as null_passenger_count,
             count(*) - count(trip_distance) as null_trip_distance, count(*) - count(fare_amount) as null_fare_amount,
             count(*) - count(total_amount) as null_total_amount,
             min(trip_distance) as min_distance, max(trip_distance) as max_distance, avg(trip_distance) as avg_distance,
             min(fare_amount) as min_fare, max(fare_amount) as max_fare, avg(fare_amount) as avg_fare,
             min(total_amount) as min_total_amount, max(total_amount) as max_total_amount,
             avg(total_amount) as avg_total_amount, min(passenger_count) as min_passengers,
             max(passenger_count) as max_passengers, avg(passenger_count) as avg_passengers,
             count(distinct PULocationID) as distinct_pickup_zones, count(distinct DOLocationID) as distinct_dropoff_zones
           from m_trips""",
        "min_distance max_distance avg_distance min_fare max_fare avg_fare min_total_amount max_total_amount "
        "avg_total_amount avg_passengers",
    ),
    "profile_columns_subway": compose(
        " union all ".join(_column("m_subway", n, k) for n, k in SUBWAY_TYPES.items()),
        "mean_value",
    ),
    "profile_columns_trips": compose(
        " union all ".join(
            _column("m_trips", n, k)
            for n, k in TRIP_TYPES.items()
        ),
        "mean_value",
    ),
    "profile_columns_weather": compose(
        " union all ".join(_column("m_weather", n, k) for n, k in WEATHER_TYPES.items()), "mean_value"
    ),
    "profile_columns_zones": compose(
        " union all ".join(_column("m_zones", n, k) for n, k in ZONE_TYPES.items()), "mean_value"
    ),
    "profile_weather_codes": _mix("m_weather", "weather_code"),
    "profile_boroughs": _mix("m_zones", "borough"),
    "profile_ridership_summary": compose(
        """select count(total_ridership) as count, avg(total_ridership) as mean, stddev_samp(total_ridership) as std,
             min(total_ridership)::double as min, quantile_cont(total_ridership, 0.25) as p25,
             quantile_cont(total_ridership, 0.5) as p50, quantile_cont(total_ridership, 0.75) as p75,
             max(total_ridership)::double as max, skewness(total_ridership) as skewness,
             stddev_samp(total_ridership) / avg(total_ridership) as coefficient_of_variation from m_subway""",
        "mean std p25 p50 p75 skewness coefficient_of_variation",
    ),
    "profile_zone_duplicate_ids": compose(
        "select count(*) as row_count, count(*) - count(distinct location_id) as duplicate_keys from m_zones"
    ),
    "profile_event_steps": _steps("select ts::timestamp as t from events"),
    "profile_subway_steps": _steps("select timestamp_hour as t from m_subway"),
    "source_rows_per_table": compose(
        " union all ".join(
            f"select '{t}' as table_name, count(*) as row_count from {t}"
            for t in GIVEN_TABLES
        )
    ),
}


def _verdict(checks: dict[str, tuple[str, str]]) -> str:
    rows = ", ".join(f"('{n}', ({e})::bigint, ({a})::bigint)" for n, (e, a) in checks.items())
    return compose(
        f"""select check_name, expected, actual, expected is not distinct from actual as passed
            from (values {rows}) as v(check_name, expected, actual)"""
    )


def _n(table: str, where: str = "true") -> str:
    return f"select count(*) from {table} where {where}"


_GRAINS = {
    "hourly_taxi_demand": ("m_demand", "pickup_hour, pickup_location_id, dropoff_location_id"),
    "hourly_spine": ("m_spine", "timestamp_hour"),
    "hourly_context": ("m_context", "timestamp_hour"),
    "hourly_mobility": ("m_mobility", "pickup_hour, pickup_location_id, dropoff_location_id"),
    "hourly_mobility_summary": ("m_summary", "pickup_hour"),
    "zone_performance": ("m_zone_perf", "location_id"),
    "od_flow": ("m_od", "pickup_location_id, dropoff_location_id"),
    "fare_payment_metrics": ("m_payment_codes", "payment_type, payment_type_label"),
    "airport_metrics": ("m_airport_categories", "airport_category"),
    "weather_mobility_metrics": (f"({WEATHER_METRICS})", "pickup_hour"),
    "temporal_demand": (f"({TEMPORAL})", "pickup_hour"),
    "geographic_performance": ("m_geo", "location_id"),
    "fare_payment_analysis": ("m_pay_mart", "payment_type"),
    "weather_transit_analysis": ("m_weather_transit", "pickup_hour"),
    "statistical_analysis": ("m_lagged", "pickup_hour"),
}

_AIRPORT = "is_airport_pickup or is_airport_dropoff"
_STATUS = f"select warehouse_quality_status from ({DATA_QUALITY})"

VALIDATION_SQL = {
    "validate_expected_rows": _verdict(
        {
            "taxi": (_n("lineitem"), _n("m_trips")), "zones": (_n("nation"), _n("m_zones")),
            "weather": ("2184", _n("m_weather")),
            "subway": ("select count(distinct o_orderkey % 2184) from orders where o_orderkey % 10 <> 0", _n("m_subway")),
        }
    ),
    "validate_layers": _verdict(
        {
            f"staged_to_{name}": (_n("m_trips"), sql)
            for name, sql in {
                "clean": _n("m_clean"), "metrics": _n("m_metrics"),
                "demand": "select sum(trip_count) from m_demand",
                "mobility": "select sum(trip_count) from m_mobility",
                "summary": "select sum(taxi_trip_count) from m_summary",
                "od": "select sum(trips) from m_od",
                "airport_categories": "select sum(n) from m_airport_categories",
                "payment_codes": "select sum(n) from m_payment_codes",
            }.items()
        }
    ),
    "validate_grains": compose(
        " union all ".join(
            f"""select '{r}' as relation, '{keys}' as grain, count(*) as total_rows,
                (select count(*) from (select distinct {keys} from {t})) as distinct_keys,
                count(*) = (select count(*) from (select distinct {keys} from {t})) as passed from {t}"""
            for r, (t, keys) in _GRAINS.items()
        )
    ),
    "validate_domains": _verdict(
        {
            "non_positive_minutes": ("0", _n("m_metrics", "trip_duration_minutes <= 0")),
            "negative_speed": ("0", _n("m_metrics", "trip_speed_mph < 0")),
            "negative_tip_share": ("0", _n("m_metrics", "tip_percentage < 0")),
            "negative_valid_revenue": ("0", _n("m_metrics", "is_revenue_valid and total_amount < 0")),
            "negative_zone_trips": ("0", _n("m_zone_perf", "pickup_trips < 0 or dropoff_trips < 0")),
            "unmapped_zone_rows": ("0", _n("m_zone_perf", "zone is null")),
            "non_positive_od_trips": ("0", _n("m_od", "trips <= 0")),
        }
    ),
    "validate_spine_coverage": _verdict(
        {
            f"{kind}_{name}_hours": ("0", sql)
            for name, (table, col) in {
                "weather": ("m_weather", "timestamp_hour"), "subway": ("m_subway", "timestamp_hour"),
                "taxi": ("m_clean", "pickup_hour"),
            }.items()
            for kind, sql in {
                "missing": f"select count(*) from (select timestamp_hour from m_spine except select {col} from {table})",
                "extra": f"select count(*) from (select {col} from {table} except select timestamp_hour from m_spine)",
            }.items()
        }
    ),
    "validate_zone_mapping": _verdict(
        {
            f"unmapped_{side}_trips": (
                "0",
                f"select coalesce(sum(trips), 0) from m_od where not coalesce({side}_location_id in (select location_id from m_zones), false)",
            )
            for side in ("pickup", "dropoff")
        }
    ),
    "validate_suite": compose(
        "select * from (values "
        + ", ".join(
            f"('DQ-TEST-{i:02d}', '{name}', {ok})"
            for i, (name, ok) in enumerate(
                [
                    ("staging rows equal clean rows", f"({_n('m_trips')}) = ({_n('m_clean')})"),
                    ("clean rows equal metric rows", f"({_n('m_clean')}) = ({_n('m_metrics')})"),
                    ("no duplicate trip groups",
                     "not exists (select 1 from m_metrics group by pickup_datetime, dropoff_datetime, vendor_id, "
                     "pickup_location_id, dropoff_location_id, passenger_count, trip_distance, total_amount "
                     "having count(*) > 1)"),
                    ("every pickup zone is known",
                     "not exists (select 1 from m_metrics where not coalesce(pickup_location_id in (select location_id from m_zones), false))"),
                    ("every dropoff zone is known",
                     "not exists (select 1 from m_metrics where not coalesce(dropoff_location_id in (select location_id from m_zones), false))"),
                    ("spine has no gap",
                     "(select bool_and(coalesce(g = interval 1 hour, true)) from (select timestamp_hour - "
                     "lag(timestamp_hour) over (order by timestamp_hour) as g from m_spine))"),
                    ("weather present in every hour", "not exists (select 1 from m_context where temperature_2m is null)"),
                    ("ridership present in every hour", "not exists (select 1 from m_context where total_ridership is null)"),
                    ("demand keeps all trips", f"(select sum(trip_count) from m_demand) = ({_n('m_metrics')})"),
                    ("mobility mart keeps all trips", f"(select sum(trip_count) from m_mobility) = ({_n('m_metrics')})"),
                    ("hourly summary keeps all trips", f"(select sum(taxi_trip_count) from m_summary) = ({_n('m_metrics')})"),
                    ("hourly summary has one row per hour", "(select count(*) = count(distinct pickup_hour) from m_summary)"),
                    ("no negative valid revenue", f"({_n('m_metrics', 'is_revenue_valid and total_amount < 0')}) = 0"),
                    ("derived minutes are positive", f"({_n('m_metrics', 'trip_duration_minutes <= 0')}) = 0"),
                    ("tip share is not negative", f"({_n('m_metrics', 'tip_percentage < 0')}) = 0"),
                ],
                1,
            )
        )
        + ") as t(test_id, test_name, passed)"
    ),
    "validate_marts": compose(
        """select check_name, expected, actual, if(expected = actual, 'PASS', 'FAIL') as status from (values
             ('staging_to_clean_rows', (select count(*) from m_trips)::varchar, (select count(*) from m_clean)::varchar),
             ('clean_to_trip_metrics_rows', (select count(*) from m_clean)::varchar, (select count(*) from m_metrics)::varchar),
             ('trip_metrics_to_total_trips', (select count(*) from m_metrics)::varchar, (select count(*) from m_metrics)::varchar),
             ('payment_mart_to_total_trips', (select count(*) from m_metrics)::varchar, (select sum(trips) from m_pay_mart)::varchar),
             ('temporal_mart_to_total_trips', (select count(*) from m_metrics)::varchar,
               (select sum(taxi_trip_count) from m_summary)::varchar),
             ('geographic_pickups_to_total_trips', (select count(*) from m_metrics)::varchar,
               (select sum(pickup_trips) from m_geo)::varchar),
             ('warehouse_quality_status', 'PASS', ("""
        + _STATUS
        + "))) as v(check_name, expected, actual)"
    ),
    "validate_post_conditions": _verdict(
        {
            "payment_metrics_not_empty": ("1", "select (count(*) > 0)::int from m_payment_codes"),
            "payment_revenue_not_negative": ("0", _n("m_payment_codes", "revenue < 0")),
            "airport_metrics_not_empty": ("1", "select (count(*) > 0)::int from m_airport_categories"),
            "airport_trips_reconcile": (
                _n("m_metrics", "is_airport_trip"),
                "select sum(n) from m_airport_categories where airport_category <> 'Non-Airport'",
            ),
            "airport_revenue_not_negative": ("0", _n("m_airport_categories", "revenue < 0")),
            "weather_metrics_keep_hours": (_n("m_summary"), _n(f"({WEATHER_METRICS})")),
            "weather_metrics_unique_hours": (_n("m_summary"), f"select count(distinct pickup_hour) from ({WEATHER_METRICS})"),
            "weather_rain_flags_complete": ("0", _n(f"({WEATHER_METRICS})", "is_raining is null and precipitation is not null")),
            "quality_metrics_one_row": ("1", _n(f"({DATA_QUALITY})")),
            "quality_status_is_pass": ("1", f"select (warehouse_quality_status = 'PASS')::int from ({DATA_QUALITY})"),
        }
    ),
    "validate_metric_bounds": _verdict(
        {
            f"{c}_out_of_bounds": ("0", f"select count(*) from ({DATA_QUALITY}) where {c} is null or {c} < 0 or {c} > 100")
            for c in BOUNDED_PERCENTAGES
        }
        | {"hour_of_day_out_of_bounds": ("0", f"select count(*) from ({TEMPORAL}) where hour_of_day not between 0 and 23")}
    ),
    "validate_duplicate_trips": compose(
        """select pickup_datetime, dropoff_datetime, vendor_id, pickup_location_id, dropoff_location_id, passenger_count,
             trip_distance, total_amount, count(*) as row_count from m_metrics group by all having count(*) > 1""",
        "trip_distance total_amount",
    ),
    "validate_duplicate_orders": compose(
        """select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1"""
    ),
    "validate_regression_base": _verdict(
        {
            "row_count": ("2184", _n("m_lagged")),
            "unique_hours": ("2184", "select count(distinct pickup_hour) from m_lagged"),
            **{
                f"no_null_{c}": ("0", _n("m_lagged", f"{c} is null"))
                for c in (
                    "taxi_trip_count", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
                    "cloud_cover", "subway_ridership", "subway_transfers", "day_of_week",
                )
            },
            "enough_complete_rows": (
                "1",
                "select (count(*) >= 500)::int from m_lagged where taxi_trip_count_lag_168 is not null "
                "and subway_ridership_lag_24 is not null",
            ),
        }
    ),
    "validate_subway_contract": compose(
        """select count(*) as row_count, count(*) - count(distinct timestamp_hour) as duplicate_keys,
             count(*) filter (timestamp_hour is null) as null_keys,
             count(*) filter (total_ridership is null) as null_total_ridership,
             count(*) filter (total_transfers is null) as null_total_transfers,
             count(*) filter (total_ridership < 0) as negative_total_ridership,
             count(*) filter (total_transfers < 0) as negative_total_transfers from m_subway"""
    ),
    "validate_order_of_orders": "\nunion all\n".join(
        f"""select '{c}' as column_name, count(*) as row_count, count(*) - count(v) as null_count,
             count(*) filter (v < before) as descents, count(*) filter (v < before) = 0 as in_order
           from (select {c} as v, lag({c}) over (order by o_orderkey) as before from orders)"""
        for c in ("o_orderkey", "o_orderdate")
    ),
    "out_of_order_orders": """select * from (
             select o_orderkey, o_orderdate as value,
               max(o_orderdate) over (order by o_orderkey rows between unbounded preceding and 1 preceding) as latest_before
             from orders) where value < latest_before""",
    "validate_zone_contract": compose(
        """select count(*) as row_count, count(*) - count(distinct location_id) as duplicate_keys,
             count(*) filter (location_id is null) as null_keys, count(*) filter (zone is null) as null_zone,
             count(*) filter (service_zone is null) as null_service_zone from m_zones"""
    ),
}
