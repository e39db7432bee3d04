"""Oracle statements of the named relations."""

from __future__ import annotations

from oracles.base import compose, relation

_DEMAND = "total_revenue avg_total_amount total_fare_amount avg_fare_amount total_distance avg_distance avg_duration_seconds avg_passenger_count"
_SUMMARY = "taxi_revenue taxi_distance"
_ZONE = (
    "pickup_revenue dropoff_revenue avg_pickup_duration_minutes avg_pickup_distance avg_fare_per_mile "
    "total_zone_revenue revenue_per_zone_activity airport_pickup_share airport_dropoff_share"
)
_MONEY = (
    "total_fare_revenue total_tip_revenue total_revenue avg_fare_amount avg_total_amount avg_tip_percentage "
    "avg_fare_per_mile avg_total_amount_per_mile tipped_trip_share revenue_per_valid_trip"
)
_MONEY_SQL = """
  count(*) as total_trips, count(*) filter (where is_revenue_valid) as valid_revenue_trips,
  sum(if(is_revenue_valid, fare_amount, 0)) as total_fare_revenue,
  sum(if(is_revenue_valid, tip_amount, 0)) as total_tip_revenue,
  sum(if(is_revenue_valid, total_amount, 0)) as total_revenue,
  avg(fare_amount) filter (is_revenue_valid) as avg_fare_amount,
  avg(total_amount) filter (is_revenue_valid) as avg_total_amount,
  count(*) filter (where is_tipped) as tipped_trips, avg(tip_percentage) as avg_tip_percentage,
  avg(fare_per_mile) as avg_fare_per_mile, avg(total_amount_per_mile) as avg_total_amount_per_mile,
  count(*) filter (where is_tipped) / count(*) as tipped_trip_share,
  sum(if(is_revenue_valid, total_amount, 0)) / nullif(count(*) filter (where is_revenue_valid), 0) as revenue_per_valid_trip
"""

_RULES = [
    ("DQ-01", "Negative duration", "Temporal", "is_negative_duration", "Duration and speed", "Critical", "Excluded from duration metrics"),
    ("DQ-02", "Zero duration", "Temporal", "is_zero_duration", "Duration and speed", "Medium", "No duration value derived"),
    ("DQ-03", "Over 24 hours", "Temporal", "is_long_duration", "Duration and speed", "High", "Excluded from duration metrics"),
    ("DQ-04", "Zero distance", "Distance", "is_zero_distance", "Distance and per-mile rates", "Medium", "Excluded from distance metrics"),
    ("DQ-05", "Negative distance", "Distance", "is_negative_distance", "Distance and per-mile rates", "High", "Excluded from distance metrics"),
    ("DQ-06", "Extreme distance", "Distance", "is_extreme_distance", "Distance and per-mile rates", "High", "Excluded from distance metrics"),
    ("DQ-07", "Negative fare", "Financial", "is_negative_fare", "Fare totals and averages", "High", "Kept and flagged"),
    ("DQ-08", "Zero fare", "Financial", "is_zero_fare", "Fare averages and tip share", "Low", "Kept and flagged"),
    ("DQ-09", "Negative total", "Financial", "is_negative_total", "Revenue", "Critical", "Excluded from valid revenue"),
    ("DQ-10", "Zero total", "Financial", "is_zero_total", "Revenue per trip", "Low", "Kept and flagged"),
    ("DQ-11", "Unknown passengers", "Passenger", "is_unknown_passenger", "Passenger averages", "Medium", "Excluded from passenger metrics"),
    ("DQ-12", "Zero passengers", "Passenger", "is_zero_passenger", "Passenger averages", "Medium", "Excluded from passenger metrics"),
    ("DQ-13", "High passenger count", "Passenger", "is_high_passenger_count", "Passenger averages", "Low", "Kept and flagged"),
    ("DQ-14", "Unknown payment", "Payment", "is_unknown_payment", "Payment mix", "Low", "Grouped as Unknown"),
    ("DQ-15", "Missing pickup zone", "Referential", "is_missing_pickup_zone", "Zone activity", "Critical", "Kept without a zone"),
    ("DQ-16", "Missing dropoff zone", "Referential", "is_missing_dropoff_zone", "Zone activity", "Critical", "Kept without a zone"),
]
ANOMALIES = " union all ".join(
    f"""select '{i}' as issue_id, '{n}' as issue_name, '{c}' as issue_category,
        count(*) filter (where {f}) as affected_rows, 100.0 * count(*) filter (where {f}) / count(*) as affected_pct,
        coalesce(sum(total_amount) filter ({f}), 0) as affected_revenue, '{f}' as rule,
        '{k}' as kpi_impact, '{s}' as severity, '{t}' as treatment from m_clean"""
    for i, n, c, f, k, s, t in _RULES
)

_QUALITY_COUNTS = ",\n".join(
    f"(select count(*) from m_metrics where {cond}) as {name}"
    for name, cond in {
        "missing_pickup_zone_trips": "is_missing_pickup_zone",
        "missing_dropoff_zone_trips": "is_missing_dropoff_zone",
        "invalid_duration_trips": "not is_duration_valid",
        "invalid_distance_trips": "not is_distance_valid",
        "invalid_revenue_trips": "not is_revenue_valid",
        "invalid_passenger_trips": "not is_passenger_valid",
        "missing_fare_trips": "is_missing_fare",
        "negative_fare_trips": "is_negative_fare",
        "zero_fare_trips": "is_zero_fare",
        "missing_total_trips": "is_missing_total",
        "negative_total_trips": "is_negative_total",
        "zero_total_trips": "is_zero_total",
        "unknown_passenger_trips": "is_unknown_passenger",
        "zero_passenger_trips": "is_zero_passenger",
        "high_passenger_trips": "is_high_passenger_count",
        "unknown_payment_trips": "is_unknown_payment",
        "missing_valid_duration_metric_trips": "trip_duration_minutes is null",
        "non_positive_distance_trips": "trip_distance is null or trip_distance <= 0",
        "valid_duration_metric_trips": "trip_duration_minutes is not null",
        "valid_speed_metric_trips": "trip_speed_mph is not null",
        "valid_fare_per_mile_trips": "fare_per_mile is not null",
        "valid_total_per_mile_trips": "total_amount_per_mile is not null",
        "valid_tip_percentage_trips": "tip_percentage is not null",
        "total_trips": "true",
    }.items()
)

DATA_QUALITY = f"""
select c.*,
  100.0 * (total_trips - missing_pickup_zone_trips) / nullif(total_trips, 0) as pickup_zone_completeness_pct,
  100.0 * (total_trips - missing_dropoff_zone_trips) / nullif(total_trips, 0) as dropoff_zone_completeness_pct,
  100.0 * (total_trips - invalid_duration_trips) / nullif(total_trips, 0) as duration_validity_pct,
  100.0 * (total_trips - invalid_distance_trips) / nullif(total_trips, 0) as distance_validity_pct,
  100.0 * (total_trips - invalid_revenue_trips) / nullif(total_trips, 0) as revenue_validity_pct,
  100.0 * (total_trips - invalid_passenger_trips) / nullif(total_trips, 0) as passenger_validity_pct,
  100.0 * (hourly_rows - incomplete_weather_hours) / nullif(hourly_rows, 0) as weather_completeness_pct,
  100.0 * (hourly_rows - missing_subway_hours) / nullif(hourly_rows, 0) as subway_completeness_pct,
  case when staging_taxi_rows = clean_taxi_rows and clean_taxi_rows = trip_metric_rows
        and missing_pickup_zone_trips + missing_dropoff_zone_trips = 0
        and incomplete_weather_hours + missing_subway_hours = 0 and invalid_od_rows = 0
       then 'PASS' else 'REVIEW' end as warehouse_quality_status
from (select
  (select count(*) from m_trips) as staging_taxi_rows, (select count(*) from m_clean) as clean_taxi_rows,
  (select count(*) from m_metrics) as trip_metric_rows, (select count(*) from m_zones) as taxi_zone_rows,
  (select count(*) from m_spine) as hourly_spine_rows,
  {_QUALITY_COUNTS},
  (select count(*) from m_summary) as hourly_rows,
  (select count(distinct pickup_hour) from m_summary) as unique_hours,
  (select min(pickup_hour) from m_summary) as earliest_hour,
  (select max(pickup_hour) from m_summary) as latest_hour,
  (select count(*) from m_summary where temperature_2m is null or relative_humidity_2m is null
      or precipitation is null or wind_speed_10m is null or cloud_cover is null) as incomplete_weather_hours,
  (select count(*) from m_summary where subway_ridership is null) as missing_subway_hours,
  (select count(*) from m_summary where taxi_trip_count is null) as missing_taxi_demand_hours,
  (select count(*) from m_zone_perf) as zone_rows,
  (select count(distinct location_id) from m_zone_perf) as unique_zone_locations,
  (select count(*) from m_zone_perf where zone is null) as missing_zone_names,
  (select count(*) from m_zone_perf where service_zone is null) as missing_service_zones,
  (select count(*) from m_od) as od_rows,
  (select count(*) from (select distinct pickup_location_id, dropoff_location_id from m_od)) as unique_od_pairs,
  (select sum(trips)::bigint from m_od) as od_trip_total,
  (select count(*) from m_od where trips <= 0) as invalid_od_rows
) c
"""

EXECUTIVE = """
select t.*, 100.0 * airport_trips / nullif(total_trips, 0) as airport_share_pct, p.*,
  100.0 * peak_hour_trips / avg_daily_trips as peak_hour_share_pct, h.*, d.*,
  100.0 * hourly_demand_stddev / avg_hourly_trips as hourly_demand_cv_pct,
  100.0 * daily_demand_stddev / avg_daily_trips as daily_demand_cv_pct
from (select count(*) as total_trips, coalesce(sum(passenger_count), 0)::bigint as total_passengers,
    sum(fare_amount) as total_fare_amount, sum(m.total_amount) as total_amount,
    sum(trip_distance) filter (trip_distance > 0) as total_distance,
    sum(trip_duration_minutes) as total_duration_minutes,
    avg(fare_amount / trip_distance) filter (trip_distance > 0) as avg_fare_per_mile,
    avg(m.total_amount / trip_duration_minutes) as avg_amount_per_minute,
    avg(m.total_amount) as avg_amount_per_trip, avg(trip_distance) as avg_distance_per_trip,
    avg(trip_duration_minutes) as avg_duration_minutes, avg(trip_speed_mph) as avg_speed_mph,
    quantile_cont(m.total_amount, 0.5) as median_amount_per_trip,
    quantile_cont(trip_distance, 0.5) as median_distance,
    quantile_cont(trip_duration_minutes, 0.5) as median_duration_minutes,
    count(*) filter (where is_tipped) as tipped_trips, avg(tip_percentage) as avg_tip_percentage,
    count(*) filter (where is_airport_trip) as airport_trips from m_metrics m) t,
  (select hour_of_day as peak_hour, avg(taxi_trip_count) as peak_hour_trips from m_summary
   group by 1 order by 2 desc, 1 limit 1) p,
  (select avg(taxi_trip_count) as avg_hourly_trips, stddev_samp(taxi_trip_count) as hourly_demand_stddev
   from m_summary) h,
  (select avg(n) as avg_daily_trips, stddev_samp(n) as daily_demand_stddev
   from (select sum(taxi_trip_count) as n from m_summary group by calendar_date)) d
"""

TEMPORAL = """
select pickup_hour, calendar_date, hour_of_day, day_of_week, is_weekend, week_start, month_start,
  taxi_trip_count, taxi_revenue, taxi_distance, taxi_duration_seconds, subway_ridership, subway_transfers,
  temperature_2m, precipitation, rain, snowfall,
  avg(taxi_trip_count) over h as hour_avg_trips, median(taxi_trip_count) over h as hour_median_trips,
  stddev_samp(taxi_trip_count) over h as hour_stddev_trips,
  (sum(taxi_trip_count) over h)::bigint as hour_total_trips, count(*) over h as hour_observations,
  avg(taxi_trip_count) over d as day_avg_trips, (sum(taxi_trip_count) over d)::bigint as day_total_trips,
  count(*) over d as day_observations, avg(taxi_trip_count) over () as overall_avg_hourly_demand,
  stddev_samp(taxi_trip_count) over () as overall_stddev_hourly_demand,
  max(taxi_trip_count) over () as overall_max_hourly_demand,
  100.0 * taxi_trip_count / avg(taxi_trip_count) over () as demand_index_pct,
  100.0 * stddev_samp(taxi_trip_count) over () / avg(taxi_trip_count) over () as overall_demand_cv_pct
from m_summary window h as (partition by hour_of_day), d as (partition by day_of_week, is_weekend)
"""

WEATHER_METRICS = """
select pickup_hour, hour_of_day, is_weekend, month_start, taxi_trip_count, subway_ridership, subway_transfers,
  temperature_2m, relative_humidity_2m, precipitation, rain, wind_speed_10m, cloud_cover,
  case when precipitation is null then 'Unknown' when precipitation = 0 then 'Dry'
       when precipitation <= 1 then 'Light Rain' when precipitation <= 5 then 'Moderate Rain'
       else 'Heavy Rain' end as precipitation_category,
  precipitation > 0 as is_raining,
  case when temperature_2m is null then 'Unknown' when temperature_2m < 5 then 'Cold'
       when temperature_2m < 15 then 'Cool' when temperature_2m < 25 then 'Mild'
       when temperature_2m < 32 then 'Warm' else 'Hot' end as temperature_category,
  taxi_trip_count / nullif(subway_ridership, 0) as taxi_to_subway_ratio,
  taxi_trip_count / nullif(subway_ridership, 0) as taxi_subway_demand_ratio,
  temperature_2m is not null and relative_humidity_2m is not null and precipitation is not null
    and wind_speed_10m is not null and cloud_cover is not null as weather_complete
from m_summary
"""

RELATION_SQL: dict[str, str] = {
    "stage_taxi_trips": compose(
        "select * from m_trips where tpep_pickup_datetime >= timestamp '2024-04-01' "
        "and tpep_pickup_datetime < timestamp '2024-07-01'",
        "trip_distance fare_amount tip_amount total_amount",
    ),
    "stage_taxi_zones": compose("select * from m_zones"),
    "subway_hourly_rollup": compose("select * from m_subway"),
    "taxi_trips_clean": compose("select * from m_clean", "trip_distance fare_amount tip_amount total_amount"),
    "trip_metrics": compose(
        "select * from m_metrics",
        "trip_distance fare_amount tip_amount total_amount trip_duration_minutes trip_speed_mph fare_per_mile "
        "total_amount_per_mile total_amount_per_minute tip_percentage",
    ),
    "hourly_taxi_demand": compose("select * from m_demand", _DEMAND),
    "hourly_spine": compose("select * from m_observed_spine"),
    "hourly_context": compose("select * from m_context"),
    "hourly_mobility": compose("select * from m_mobility", _DEMAND),
    "hourly_mobility_summary": compose("select * from m_summary", _SUMMARY),
    "hourly_mobility_rollup": compose("select * from m_summary", _SUMMARY),
    "zone_performance": compose("select * from m_zone_perf", _ZONE),
    "od_flow": compose(
        "select * from m_od",
        "total_revenue avg_trip_distance avg_trip_duration_minutes avg_total_amount avg_fare_per_mile",
    ),
    "fare_payment_metrics": compose(
        f"""select payment_type, payment_type_label, {_MONEY_SQL},
          avg(tip_amount) filter (is_revenue_valid) as avg_tip_amount,
          count(*) filter (where is_zero_fare) as zero_fare_trips,
          count(*) filter (where is_negative_fare) as negative_fare_trips,
          count(*) filter (where is_zero_total) as zero_total_trips,
          count(*) filter (where is_negative_total) as negative_total_trips,
          count(*) filter (where is_airport_trip) as airport_trips,
          sum(if(is_airport_trip and is_revenue_valid, total_amount, 0)) as airport_revenue
        from m_metrics group by 1, 2""",
        f"{_MONEY} avg_tip_amount airport_revenue",
    ),
    "airport_metrics": compose(
        f"""select case when pu = dz then case pu when 'JFK' then 'JFK to JFK' else 'LaGuardia to LaGuardia' end
              when pu is not null and dz is not null then pu || ' to ' || dz
              when pu = 'JFK' or dz = 'JFK' then 'JFK ' || if(pu is null, 'Dropoff', 'Pickup')
              when pu is not null then 'LaGuardia Pickup' when dz is not null then 'LaGuardia Dropoff'
              else 'Non-Airport' end as airport_category, {_MONEY_SQL},
          avg(trip_distance) filter (is_distance_valid) as avg_trip_distance,
          avg(trip_duration_minutes) as avg_trip_duration_minutes,
          coalesce(sum(passenger_count), 0)::bigint as total_passengers,
          avg(passenger_count) filter (passenger_count > 0) as avg_passengers
        from (select *, case pickup_location_id when 132 then 'JFK' when 138 then 'LaGuardia' end as pu,
                case dropoff_location_id when 132 then 'JFK' when 138 then 'LaGuardia' end as dz
              from m_metrics) group by 1""",
        f"{_MONEY} avg_trip_distance avg_trip_duration_minutes avg_passengers",
    ),
    "weather_mobility_metrics": compose(WEATHER_METRICS, "taxi_to_subway_ratio taxi_subway_demand_ratio"),
    "data_quality_metrics": compose(
        DATA_QUALITY,
        "pickup_zone_completeness_pct dropoff_zone_completeness_pct duration_validity_pct "
        "distance_validity_pct revenue_validity_pct passenger_validity_pct weather_completeness_pct "
        "subway_completeness_pct",
    ),
    "data_quality_anomalies": compose(ANOMALIES, "affected_pct affected_revenue"),
    "quality_totals": compose(
        f"""select count(*) as quality_rules, sum(affected_rows)::bigint as issue_flags,
            sum(affected_revenue) as flagged_revenue from ({ANOMALIES})""",
        "flagged_revenue",
    ),
    "executive_mobility": compose(
        EXECUTIVE,
        "total_fare_amount total_amount total_distance total_duration_minutes avg_fare_per_mile "
        "avg_amount_per_minute avg_amount_per_trip avg_distance_per_trip avg_duration_minutes avg_speed_mph "
        "median_amount_per_trip median_distance median_duration_minutes avg_tip_percentage airport_share_pct "
        "peak_hour_trips peak_hour_share_pct avg_hourly_trips hourly_demand_stddev hourly_demand_cv_pct "
        "avg_daily_trips daily_demand_stddev daily_demand_cv_pct",
        digits=4,
    ),
    "temporal_demand": compose(
        TEMPORAL,
        f"{_SUMMARY} hour_avg_trips hour_median_trips hour_stddev_trips day_avg_trips overall_avg_hourly_demand "
        "overall_stddev_hourly_demand demand_index_pct overall_demand_cv_pct",
    ),
    "geographic_performance": compose(
        "select * from m_geo",
        f"{_ZONE} activity_percentile zone_activity_contribution_pct zone_revenue_contribution_pct",
    ),
    "fare_payment_analysis": compose(
        "select * from m_pay_mart",
        "fare_amount total_amount total_distance total_duration_minutes avg_fare median_fare avg_amount "
        "median_amount amount_stddev avg_fare_per_mile avg_amount_per_minute avg_distance avg_duration_minutes "
        "avg_speed_mph avg_tip_percentage median_tip_percentage total_tips trip_share_pct amount_share_pct "
        "tipping_rate_pct airport_share_pct",
        digits=4,
    ),
    "weather_transit_analysis": compose(
        "select * from m_weather_transit",
        "taxi_revenue taxi_distance amount_per_trip distance_per_trip duration_minutes_per_trip subway_to_taxi_ratio "
        "category_avg_taxi_trips category_avg_taxi_revenue category_avg_distance_per_trip "
        "category_avg_duration_per_trip category_avg_amount_per_trip category_avg_subway_ridership "
        "category_avg_subway_transfers",
    ),
    "statistical_analysis": compose("select * from m_lagged", _SUMMARY),
}

# Hourly readings as the files hold them: made of the orders of each hour, with codes that do not parse.
relation("m_readings", """
select timestamp '2024-04-01' + to_hours(h) as timestamp_hour, (k % 400) / 10.0::double as temperature_2m,
  (k % 101)::int as relative_humidity_2m, (k % 50) / 10.0::double as precipitation, (k % 30) / 10.0::double as rain,
  0::double as snowfall, case when k % 17 <> 0 then (k % 90)::int end as weather_code,
  (k % 300) / 10.0::double as wind_speed_10m, (n % 101)::int as cloud_cover
from (select o_orderkey % 2184 as h, count(*) as n, sum(o_orderkey)::bigint as k from orders group by 1)
""")
_READ = "temperature_2m precipitation rain snowfall wind_speed_10m"

relation("m_drifted", """
select tpep_pickup_datetime, PULocationID::bigint as PULocationID, payment_type::varchar as payment_type,
  case when month(tpep_pickup_datetime) = 4 then floor(fare_amount) else fare_amount end as fare_amount,
  case when month(tpep_pickup_datetime) <> 5 then congestion_surcharge end as congestion_surcharge,
  month(tpep_pickup_datetime) - 4 as schema_group
from m_trips where tpep_pickup_datetime >= timestamp '2024-04-01' and tpep_pickup_datetime < timestamp '2024-07-01'
""")

RELATION_SQL |= {
    "read_drifted_months": compose(
        "select * exclude (schema_group) from m_drifted", "fare_amount congestion_surcharge"
    ),
    "schema_drift_report": compose("""
select column_name, g.schema_group::int as schema_group, 1 as files, own_type, common_type,
  case when own_type is null then 'missing' when common_type is null then 'conflict'
       when own_type = common_type then 'same' else 'widened' end as status, row_count
from (values ('tpep_pickup_datetime', ['timestamp_ntz', 'timestamp_ntz', 'timestamp_ntz'], 'timestamp_ntz'),
             ('PULocationID', ['int', 'int', 'bigint'], 'bigint'), ('payment_type', ['bigint', 'bigint', 'string'], null),
             ('fare_amount', ['int', 'double', 'double'], 'double'),
             ('congestion_surcharge', ['double', null, 'double'], 'double')) as t(column_name, types, common_type),
     (select schema_group, count(*) as row_count from m_drifted group by 1) g, lateral (select types[g.schema_group + 1] as own_type)
"""),
    "read_trip_months": compose(
        "select * from m_trips where tpep_pickup_datetime >= timestamp '2024-04-15' "
        "and tpep_pickup_datetime < timestamp '2024-06-02 12:00:00'",
        "trip_distance fare_amount tip_amount total_amount",
    ),
    "read_zones_csv": compose("select * from m_zones"),
    "read_weather_csv": compose("select * from m_readings", _READ),
    "read_weather_payload": compose("select * from m_readings", _READ),
    "read_subway_csv": compose(
        """select timestamp_hour, case when total_ridership % 13 <> 0 then total_ridership end as total_ridership,
             total_transfers from m_subway"""
    ),
    "listed_geographic_performance": compose(
        "select location_id, activity_rank, row_number() over (order by activity_rank, location_id)::int as place from m_geo"
    ),
    "listed_fare_payment_analysis": compose(
        """select payment_type, total_amount, row_number() over (order by total_amount desc, payment_type)::int as place
           from m_pay_mart""",
        "total_amount",
    ),
    "payment_view_of_a_label": RELATION_SQL["fare_payment_analysis"].replace(
        "from m_pay_mart", "from m_pay_mart where payment_type_label = 'Cash'"
    ),
}
