"""The demand-model studies: prediction models, association models and residual diagnostics."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.config import DEFAULT, MobilityConfig
from curbflow.functions import tails
from curbflow.functions.measures import rows
from curbflow.operators.series import numbered, with_halo, with_lags
from curbflow.plans.regression_base import lags_of
from curbflow.session import write_and_read
from curbflow.stats.design import (
    CONST, Design, Spec, all_levels, chronological_split, complete_rows, design_matrix, term_names,
)
from curbflow.stats.ols import (
    Fit, coefficient_table, fit_specs, ols, ols_family, regression_metrics, vif, with_hac,
)

TIME = ("hour_of_day", "day_of_week", "regression_month")
TAXI_LAGS = tuple(f"taxi_trip_count_lag_{k}" for k in (1, 2, 24, 168))
TRANSIT = ("subway_ridership", *(f"subway_ridership_lag_{k}" for k in (1, 2, 24)))
WEATHER = ("temperature_2m", "precipitation", "rain_flag")
AMBIENT = ("temperature_2m", "relative_humidity_2m", "wind_speed_10m", "cloud_cover")

# Terms of the four nested prediction models. The third adds weather on top of transit.
PREDICTION_SPECS = (
    Spec("model_1_temporal_baseline", TAXI_LAGS, TIME),
    Spec("model_2_transit", TAXI_LAGS + TRANSIT, TIME),
    Spec("model_3_weather", TAXI_LAGS + TRANSIT + WEATHER, TIME),
    Spec(
        "model_4_reduced",
        ("taxi_trip_count_lag_1", "taxi_trip_count_lag_24", "taxi_trip_count_lag_168", "subway_ridership", *WEATHER),
        TIME,
    ),
)
COMPLETE_COLUMNS = ("taxi_trip_count", *TAXI_LAGS, *TRANSIT, *WEATHER, *TIME)


class PredictionStudy:
    """The four models fitted on the first 80 percent of complete hours and judged on the rest.

    The complete hourly rows are written once; every fit and diagnostic reads that small table.
    """

    def __init__(self, base: DataFrame, config: MobilityConfig = DEFAULT, specs=PREDICTION_SPECS):
        self.spark = base.sparkSession
        complete = chronological_split(complete_rows(base, COMPLETE_COLUMNS), config.test_share)
        self.hours = write_and_read(complete, "model-hours")
        self.levels = all_levels(self.hours, TIME)
        self.n = self.hours.count()
        if self.n < config.minimum_model_rows:
            raise ValueError(f"{self.n} complete hours are too few for the models")
        self.specs = {s.name: s for s in specs}
        numeric = tuple(dict.fromkeys(c for s in specs for c in s.continuous))
        calendar = tuple(dict.fromkeys(c for s in specs for c in s.categorical))
        # One design holds every model's terms, so that all models share the passes over the rows.
        self.shared = design_matrix(
            self.hours, Spec("shared", numeric, calendar), carry=("is_train",), known_levels=self.levels
        )

    @cached_property
    def fits(self) -> dict[str, Fit]:
        train = replace(self.shared, frame=self.shared.frame.where("is_train"))
        return ols_family(train, {name: term_names(spec, self.levels) for name, spec in self.specs.items()})

    def predictions(self, *names: str) -> DataFrame:
        """Every complete hour with its sample and, per model, a prediction and residual."""
        per_model = [
            F.struct(F.lit(n).alias("model"), self.fits[n].predicted().alias("prediction"))
            for n in names or self.specs
        ]
        return self.shared.frame.select("pickup_hour", "is_train", "y", F.inline(F.array(*per_model))).withColumn(
            "residual", F.col("y") - F.col("prediction")
        )

    def coefficients(self, *names: str) -> DataFrame:
        return coefficient_table(self.spark, [self.fits[n] for n in names or self.specs])

    def metrics(self, *names: str) -> DataFrame:
        """Error measures of the training and the test sample per model."""
        sample = F.when(F.col("is_train"), "train").otherwise("test")
        return regression_metrics(self.predictions(*names).withColumn("sample", sample), ("model", "sample"))

    def comparison(self) -> DataFrame:
        fitted = self.spark.createDataFrame(
            [(n, f.adjusted_r_squared, f.aic, f.bic) for n, f in self.fits.items()],
            "model string, adjusted_r2 double, aic double, bic double",
        )
        wide = self.metrics().groupBy("model").agg(
            *(
                F.max(F.when(F.col("sample") == s, F.col(m))).alias(f"{s}_{m}")
                for m in ("r2", "mae", "rmse")
                for s in ("train", "test")
            )
        )
        return wide.join(fitted, "model").orderBy("model")

    def fit_summary(self) -> DataFrame:
        found = [
            (n, f.n, f.rank, f.r_squared, f.adjusted_r_squared, f.f_statistic, f.aic, f.bic) for n, f in self.fits.items()
        ]
        rows_of = self.spark.createDataFrame(
            found,
            "model string, observations long, rank int, r_squared double, adjusted_r_squared double, "
            "f_statistic double, aic double, bic double",
        )
        rank = F.col("rank").cast("double")
        return rows_of.withColumn("f_p_value", tails.f_tail(F.col("f_statistic"), rank - 1, F.col("observations") - rank))

    def test_errors(self, name: str) -> DataFrame:
        error = F.abs("residual")
        return self.predictions(name).where(~F.col("is_train")).select(
            "pickup_hour", F.col("y").alias("taxi_trip_count"), "prediction", "residual",
            error.alias("abs_error"), (F.col("residual") * F.col("residual")).alias("squared_error"),
            F.hour("pickup_hour").alias("hour_of_day"),
            F.weekday("pickup_hour").alias("day_of_week"),
            (F.weekday("pickup_hour") >= 5).alias("is_weekend"),
        )

    def error_by(self, name: str, column: str) -> DataFrame:
        return self.test_errors(name).groupBy(column).agg(
            rows().alias("observations"),
            F.avg("abs_error").alias("mae"),
            F.sqrt(F.avg("squared_error")).alias("rmse"),
        ).orderBy(F.desc("mae"), column)

    def worst_predictions(self, name: str, k: int = 20) -> DataFrame:
        return (
            self.test_errors(name)
            .orderBy(F.desc("abs_error"), "pickup_hour")
            .limit(k)
            .select("pickup_hour", "taxi_trip_count", "prediction", "abs_error", "hour_of_day", "is_weekend")
        )

    def training_residuals(self, name: str) -> DataFrame:
        return self.predictions(name).where("is_train").select("pickup_hour", "residual")

    def residual_diagnostics(self, name: str) -> DataFrame:
        r, size = F.col("residual"), F.abs("residual")
        return self.training_residuals(name).agg(
            F.avg(r).alias("mean_residual"),
            F.median(r).alias("median_residual"),
            F.stddev_samp(r).alias("std_residual"),
            F.min(r).alias("min_residual"),
            F.max(r).alias("max_residual"),
            F.percentile(size, 0.95).alias("residual_p95_abs"),
            F.percentile(size, 0.99).alias("residual_p99_abs"),
        )

    def vif(self, name: str = "model_4_reduced") -> DataFrame:
        columns = tuple(t for t in term_names(self.specs[name], self.levels) if t != CONST)
        return self.spark.createDataFrame(
            vif(self.shared.frame, columns, centred=False), "feature string, vif double"
        ).orderBy(F.desc("vif"))

    def subway_residuals(self) -> DataFrame:
        """Each complete hour's ridership beside the demand left after lags and calendar."""
        spec = Spec("temporal_controls", TAXI_LAGS, TIME)
        design = design_matrix(self.hours, spec, carry=("subway_ridership",), known_levels=self.levels)
        return ols(design, spec.name).with_residuals(design).select(
            "pickup_hour", F.col("y").alias("taxi_trip_count"), "prediction", "residual", "subway_ridership"
        )

    def subway_residual_correlation(self) -> DataFrame:
        return self.subway_residuals().agg(
            rows().alias("hours"), F.corr("residual", "subway_ridership").alias("residual_correlation")
        )


# Association models on the hourly summary, name -> numeric terms beside the calendar controls.
ASSOCIATION_SPECS = (
    Spec("raw_subway", ("subway_ridership",)),
    Spec("subway_time", ("subway_ridership",), TIME),
    Spec(
        "subway_weather_time",
        ("subway_ridership", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "cloud_cover"),
        TIME,
    ),
    Spec("rain_subway_time", ("rain_flag", "subway_ridership", *AMBIENT), TIME),
)
SUBWAY_LAG_SPEC = Spec(
    "subway_lags", ("subway_ridership", *(f"subway_ridership_lag_{k}" for k in (1, 2, 3))), TIME
)
_LADDER_BASE = ("subway_ridership", "rain_flag", *AMBIENT)
# Demand-lag ladder: spec and the Newey-West lags of its covariance.
LADDER = (
    (Spec("baseline", _LADDER_BASE, TIME), 24),
    (Spec("short_lags", _LADDER_BASE + TAXI_LAGS[:2], TIME), 24),
    (Spec("full_lags", _LADDER_BASE + TAXI_LAGS, TIME), 168),
)
DIAGNOSTIC_SPEC = Spec("lagged_demand", ("rain_flag", "subway_ridership", *AMBIENT, *TAXI_LAGS), TIME)
HAC_LAGS = (6, 12, 24, 48, 168)
COMPARISON_SCHEMA = "model string, observations long, r_squared double, adjusted_r_squared double, aic double, bic double"


class AssociationStudy:
    """Newey-West models of demand on ridership, weather and calendar over the whole series."""

    def __init__(self, base: DataFrame):
        self.spark = base.sparkSession
        third_lag = with_lags(base, "pickup_hour", lags_of("subway_ridership", (3,)))
        self.hours = write_and_read(third_lag, "association-hours")
        self.levels = all_levels(self.hours, TIME)

    def fit(self, *specs: Spec) -> dict[str, tuple[Fit, Design]]:
        return fit_specs(self.hours, specs, self.levels)

    def robust(self, spec_lags: tuple[tuple[Spec, int], ...]) -> list[Fit]:
        fitted = self.fit(*(s for s, _ in spec_lags))
        return [with_hac(*fitted[s.name], (lags,))[lags] for s, lags in spec_lags]

    def _comparison(self, specs: tuple[Spec, ...]) -> DataFrame:
        fits = [f for f, _ in self.fit(*specs).values()]
        return self.spark.createDataFrame(
            [(f.name, f.n, f.r_squared, f.adjusted_r_squared, f.aic, f.bic) for f in fits], COMPARISON_SCHEMA
        )

    def association_coefficients(self, only: tuple[str, ...] | None = None) -> DataFrame:
        return coefficient_table(self.spark, self.robust(tuple((s, 24) for s in ASSOCIATION_SPECS)), only)

    def association_comparison(self) -> DataFrame:
        return self._comparison(ASSOCIATION_SPECS)

    def subway_lag_coefficients(self) -> DataFrame:
        return coefficient_table(self.spark, self.robust(((SUBWAY_LAG_SPEC, 24),)))

    def ladder_comparison(self) -> DataFrame:
        return self._comparison(tuple(s for s, _ in LADDER))

    def ladder_coefficients(self) -> DataFrame:
        return coefficient_table(self.spark, self.robust(LADDER))

    def hac_sensitivity(self, lags: tuple[int, ...] = HAC_LAGS) -> DataFrame:
        """The ridership coefficient under several lag choices: one fit, one pass for all choices."""
        spec = ASSOCIATION_SPECS[1]
        choices = with_hac(*self.fit(spec)[spec.name], lags)
        named = [replace(choices[k], name=str(k)) for k in lags]
        found = coefficient_table(self.spark, named, ("subway_ridership",))
        return found.withColumn("hac_lags", F.col("model").cast("int")).drop("model", "feature", "significant_05")

    def vif(self) -> DataFrame:
        columns = ("subway_ridership", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
                   "cloud_cover")
        complete = complete_rows(self.hours, columns)
        return self.spark.createDataFrame(vif(complete, columns, centred=True), "variable string, vif double")

    def diagnostic(self) -> tuple[Fit, DataFrame]:
        """Lagged-demand model without its covariance, and its residual series."""
        fit, design = self.fit(DIAGNOSTIC_SPEC)[DIAGNOSTIC_SPEC.name]
        return fit, fit.with_residuals(design).select("pickup_hour", "residual")

    def diagnostic_summary(self) -> DataFrame:
        fit, residuals = self.diagnostic()
        hours = self.hours.agg(rows()).scalar()
        r = F.col("residual")
        return residuals.agg(
            rows().alias("observations"),
            (hours - rows()).alias("lost_to_lags"),
            F.lit(fit.r_squared).alias("r_squared"),
            F.lit(fit.adjusted_r_squared).alias("adjusted_r_squared"),
            F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"), F.min(r).alias("min"),
            *(F.percentile(r, q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)),
            F.max(r).alias("max"),
        )

    def diagnostic_coefficients(self) -> DataFrame:
        return coefficient_table(self.spark, self.robust(((DIAGNOSTIC_SPEC, 168),)))


ACF_LAGS = (1, 2, 3, 6, 12, 24, 48, 168)
LJUNG_BOX_LAGS = (1, 6, 12, 24, 48, 168)


def autocorrelation(series: DataFrame, column: str, lags: tuple[int, ...] = ACF_LAGS) -> DataFrame:
    """Pearson correlation of the series with itself k rows earlier, over the overlapping rows."""
    past = with_lags(series.select("pickup_hour", column), "pickup_hour", {f"past_{k}": (column, k) for k in lags})
    shifted = past.select(
        F.col(column).alias("now"),
        F.array(*(F.struct(F.lit(k).alias("lag"), F.col(f"past_{k}").alias("past")) for k in lags)).alias("pairs"),
    )
    pairs = shifted.select("now", F.inline("pairs")).where(F.col("past").isNotNull())
    return pairs.groupBy("lag").agg(F.corr("now", "past").alias("autocorrelation"))


def lag_products(series: DataFrame, column: str, max_lag: int) -> DataFrame:
    """Sum of products of deviations from the mean at each lag, 0 to max_lag.

    A row meets only the lagged values it needs: a block of rows has the max_lag rows before it as its halo, so the work
    is rows times lags and no task sees the whole series.
    """
    mean = series.agg(F.avg(column)).scalar()
    centred = series.select("pickup_hour", (F.col(column) - mean).alias("d"))
    recent = Window.partitionBy("_block").orderBy("_i").rowsBetween(-max_lag, 0)
    blocks = with_halo(numbered(centred, "pickup_hour"), max_lag)
    centred = blocks.withColumn("past", F.collect_list("d").over(recent)).where("_own")
    # `past` holds the deviations up to the current row, oldest first: reversed, position k is lag k.
    products = centred.select(
        "d", F.posexplode(F.reverse("past")).alias("lag", "earlier")
    )
    return products.groupBy("lag").agg(F.sum(F.col("d") * F.col("earlier")).alias("product_sum"), rows().alias("pairs"))


def ljung_box(series: DataFrame, column: str, lags: tuple[int, ...] = LJUNG_BOX_LAGS) -> DataFrame:
    """Ljung-Box statistic and chi-square tail at each lag; both are null for an empty or constant series."""
    sums = lag_products(series, column, max(lags))
    # one row per lag: products with later rows, the variance (lag 0) and the number of rows beside each
    every = Window.partitionBy()
    own = F.col("product_sum") / F.nullif(F.max(F.when(F.col("lag") == 0, F.col("product_sum"))).over(every), F.lit(0.0))
    n = F.max("pairs").over(every)
    parts = sums.select("lag", (own * own / (n - F.col("lag"))).alias("part"), n.cast("double").alias("n")).where("lag > 0")
    asked = F.inline(F.array(*(F.struct(F.lit(k).alias("of")) for k in lags)))
    stats = (
        parts.select("*", asked).where(F.col("lag") <= F.col("of")).groupBy("of")
        .agg((F.max("n") * (F.max("n") + 2) * F.sum("part")).alias("lb_stat"))
    )
    return stats.select(
        F.col("of").alias("lag"), "lb_stat", tails.chi_square_tail(F.col("lb_stat"), F.col("of").cast("double")).alias("lb_pvalue")
    )
