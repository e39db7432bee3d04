"""Ordered warehouse build: materialise, validate, and write result tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from curbflow.analysis import findings, validation
from curbflow.stats.models import AssociationStudy, PredictionStudy
from curbflow.warehouse import Warehouse


def write_csv(df: DataFrame, path: str) -> None:
    """Result tables are small aggregates, so one file with a header is written."""
    df.repartition(1).write.mode("overwrite").csv(path, header=True)


def enforce_validations(built: Warehouse) -> None:
    """Raise on the first validation job with a failed row, then on the quality suite."""
    for job in (
        validation.layer_reconciliation,
        validation.grain_uniqueness,
        validation.domain_checks,
        validation.zone_mapping,
        validation.post_conditions,
    ):
        failed = [r.asDict() for r in job(built).where("not passed").collect()]
        if failed:
            raise RuntimeError(f"{job.__name__}: {failed}")
    validation.enforce_suite(validation.quality_suite(built))


def run(warehouse: Warehouse, root: str, results: str, enforce: bool = True, models: bool = True) -> Warehouse:
    """Build all layers under `root`, check them, and write the analyses under `results`."""
    built = warehouse.build(root)
    if enforce:
        enforce_validations(built)
    tables = {
        "anomaly_kpi_impact": findings.anomaly_kpi_impact(built.trip_metrics),
        "recommendation_sensitivity": findings.recommendation_sensitivity(built.hourly_mobility_summary),
        "reconciliation_checks": validation.mart_reconciliation(built),
    }
    if models:
        study = PredictionStudy(built.statistical_analysis, built.config)
        association = AssociationStudy(built.statistical_analysis)
        tables |= {
            "model_comparison": study.comparison(),
            "residual_diagnostics": study.residual_diagnostics("model_4_reduced"),
            "test_error_by_hour": study.error_by("model_4_reduced", "hour_of_day"),
            "test_error_by_weekend": study.error_by("model_4_reduced", "is_weekend"),
            "vif_diagnostics": study.vif(),
            "association_coefficients": association.association_coefficients(),
            "hac_sensitivity": association.hac_sensitivity(),
            **{f"{name}_coefficients": study.coefficients(name) for name in study.specs},
            **{f"{name}_metrics": study.metrics(name) for name in study.specs},
            **{f"{name}_test_predictions": study.test_errors(name) for name in study.specs},
            **{f"{name}_training_residuals": study.training_residuals(name) for name in study.specs},
        }
    for name, df in tables.items():
        write_csv(df, os.path.join(results, name))
    return built
