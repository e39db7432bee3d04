"""Headline timings. Prints one JSON line.

The staged trips are materialised once (`build_*` entries time that), then each query runs on the
written layers after two warm-up runs; the median of BENCH_RUNS is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from curbflow.analysis import findings, profiling, validation  # noqa: E402
from curbflow.registry import open_warehouse  # noqa: E402
from curbflow.session import build_session  # noqa: E402
from curbflow.stats.models import AssociationStudy, PredictionStudy  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARM_UPS = 2
FROM_TRIPS = {
    "payment_analysis_from_trips": lambda w: findings.payment_analysis_raw(w.trip_metrics),
    "geographic_analysis_from_trips": lambda w: findings.geographic_analysis_raw(w.trip_metrics),
    "anomaly_kpi_impact": lambda w: findings.anomaly_kpi_impact(w.trip_metrics),
    "profile_source_summary": lambda w: profiling.source_summary(w.inputs.taxi_trips),
}
FROM_MARTS = {
    "payment_analysis_from_mart": lambda w: w.fare_payment_analysis.select(
        "payment_type", "trips", "total_amount", "avg_amount", "median_amount", "avg_tip_percentage"
    ),
    "geographic_analysis_from_mart": lambda w: w.geographic_performance.select(
        "location_id", "pickup_trips", "pickup_revenue", "avg_pickup_distance", "avg_pickup_duration_minutes"
    ),
    "recommendation_sensitivity": lambda w: findings.recommendation_sensitivity(w.hourly_mobility_summary),
    "quality_suite": validation.quality_suite,
    "prediction_models": lambda w: PredictionStudy(w.statistical_analysis).comparison(),
    "hac_sensitivity": lambda w: AssociationStudy(w.statistical_analysis).hac_sensitivity(),
}


def timed(job) -> float:
    started = time.perf_counter()
    job()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="bench-")
    found: dict[str, float] = {}

    raw = open_warehouse(spark, sf_dir)
    trips_path = os.path.join(work, "staged_trips")
    found["build_staged_trips"] = timed(lambda: raw.inputs.taxi_trips.write.parquet(trips_path))
    warehouse = raw.with_staged_trips(spark.read.parquet(trips_path))
    started = time.perf_counter()
    built = warehouse.build(os.path.join(work, "warehouse"))
    found["build_warehouse"] = time.perf_counter() - started

    for name, make in {**FROM_TRIPS, **FROM_MARTS}.items():
        for _ in range(WARM_UPS):
            make(built).collect()
        found[name] = statistics.median(timed(lambda: make(built).collect()) for _ in range(RUNS))

    print(
        json.dumps(
            {
                "metric": "sum of headline timings",
                "value": round(sum(found.values()), 4),
                "unit": "sec",
                "queries": {k: round(v, 4) for k, v in found.items()},
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
