"""The relations wired together. Nothing runs until an action; `build` materialises them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curbflow.config import DEFAULT, MobilityConfig
from curbflow.operators.shaping import side_by_side
from curbflow.plans import checks, geography, hourly, payments, quality, regression_base, temporal, trips, weather
from curbflow.session import with_settings
from curbflow.sources.staging import StagedInputs

# Layers written together; each wave reads only the layers of earlier waves.
WAVES = (
    ("trips_clean", "hourly_spine", "hourly_context"),
    ("hourly_taxi_demand",),
    (
        "hourly_mobility", "hourly_mobility_summary", "zone_performance", "od_flow", "fare_payment_metrics",
        "airport_metrics", "data_quality_anomalies", "fare_payment_analysis",
    ),
    (
        "weather_mobility_metrics", "data_quality_metrics", "executive_mobility", "temporal_demand",
        "geographic_performance", "weather_transit_analysis", "statistical_analysis",
    ),
)
# A projection of the clean trips: reading those again costs less than a second wide copy of all trips.
VIEWS = ("trip_metrics",)
LAYERS = (*(name for wave in WAVES for name in wave), *VIEWS)
PARTITIONED_BY = {"trips_clean": "pickup_month", "hourly_mobility": "month_start"}
# Jobs of one wave submitted at a time; the cluster's scheduler shares executors among them.
CONCURRENT_WRITES = 4


# Rows of a file of a partitioned layer at most; it bounds a row group, which is read by one task.
ROWS_PER_FILE = 1_000_000
# A task holds a file open for each month it meets, up to this many, and so writes wide rows without sorting them; Spark
# sorts what is left of a task that meets more. A task reads this much at most: where few trips share an hour and a zone
# pair, it holds a wide group for nearly every trip it reads.
WRITE_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "16", "spark.sql.files.maxPartitionBytes": "32m"}
# What each relation is computed from, where a written layer is asked for alone.
SOURCES = {
    "trip_metrics": ("trips_clean",),
    "hourly_context": ("hourly_spine",),
    "hourly_taxi_demand": ("trips_clean",),
    "hourly_mobility": ("hourly_taxi_demand", "hourly_context"),
    "hourly_mobility_summary": ("hourly_taxi_demand", "hourly_context"),
    "zone_performance": ("trip_metrics",),
    "od_flow": ("trip_metrics",),
    "fare_payment_metrics": ("trip_metrics",),
    "airport_metrics": ("trip_metrics",),
    "fare_payment_analysis": ("trip_metrics",),
    "data_quality_anomalies": ("trips_clean",),
    "weather_mobility_metrics": ("hourly_mobility_summary",),
    "data_quality_metrics": (
        "trips_clean", "trip_metrics", "hourly_spine", "hourly_mobility_summary", "zone_performance", "od_flow",
    ),
    "executive_mobility": ("trip_metrics", "hourly_mobility_summary"),
    "temporal_demand": ("hourly_mobility_summary",),
    "geographic_performance": ("zone_performance",),
    "weather_transit_analysis": ("hourly_mobility_summary",),
    "statistical_analysis": ("hourly_mobility_summary",),
}


def with_sources(layers: tuple[str, ...]) -> tuple[str, ...]:
    """The layers and everything they are computed from."""
    found: list[str] = []

    def visit(name: str) -> None:
        for source in SOURCES.get(name, ()):
            visit(source)
        if name not in found:
            found.append(name)

    for name in layers:
        visit(name)
    return tuple(found)


def _write_layer(root: str, name: str, df: DataFrame) -> None:
    """Each task writes its own rows, unsorted, in files of bounded size: the rows cross no network. A partition value has
    as many files as tasks held it, and more where it exceeds a file."""
    writer = df.write.mode("overwrite")
    if name in PARTITIONED_BY:
        writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(PARTITIONED_BY[name])
    writer.parquet(f"{root}/{name}")


class Warehouse:
    """Each attribute is one relation; downstream relations read the upstream attributes."""

    def __init__(self, spark: SparkSession, inputs: StagedInputs, config: MobilityConfig = DEFAULT):
        self.spark, self.inputs, self.config = spark, inputs, config
        self.zones = inputs.taxi_zones
        self.written: set[str] = set()
        self.observed: dict[str, dict[str, int | None]] = {}

    @cached_property
    def trips_clean(self) -> DataFrame:
        return trips.taxi_trips_clean(self.inputs.taxi_trips, self.config)

    @cached_property
    def trip_metrics(self) -> DataFrame:
        return trips.trip_metrics(self.trips_clean, self.config)

    @cached_property
    def hourly_taxi_demand(self) -> DataFrame:
        return hourly.hourly_taxi_demand(self.trips_clean)

    @cached_property
    def hourly_spine(self) -> DataFrame:
        return hourly.hourly_spine(self.spark, self.config.period)

    @cached_property
    def hourly_context(self) -> DataFrame:
        return hourly.hourly_context(
            self.hourly_spine, self.inputs.weather_hourly, self.inputs.subway_hourly
        )

    @cached_property
    def hourly_mobility(self) -> DataFrame:
        return hourly.hourly_mobility(self.hourly_taxi_demand, self.hourly_context, self.zones)

    @cached_property
    def hourly_mobility_summary(self) -> DataFrame:
        """Rolled up from the demand facts once these are written, else straight from the trips."""
        if "hourly_taxi_demand" in self.written:
            return hourly.hourly_summary_from_demand(self.hourly_taxi_demand, self.hourly_context)
        return hourly.hourly_summary_from_trips(self.trips_clean, self.hourly_context)

    @cached_property
    def zone_performance(self) -> DataFrame:
        return geography.zone_performance(self.trip_metrics, self.zones)

    @cached_property
    def od_flow(self) -> DataFrame:
        return geography.od_flow(self.trip_metrics)

    @cached_property
    def fare_payment_metrics(self) -> DataFrame:
        return payments.fare_payment_metrics(self.trip_metrics)

    @cached_property
    def airport_metrics(self) -> DataFrame:
        return payments.airport_metrics(self.trip_metrics, self.config)

    @cached_property
    def weather_mobility_metrics(self) -> DataFrame:
        return weather.weather_mobility_metrics(self.hourly_mobility_summary)

    @cached_property
    def data_quality_metrics(self) -> DataFrame:
        return quality.data_quality_metrics(
            self.measured("staged").select(F.col("staged").alias("staging_taxi_rows")), self.trips_clean,
            self.trip_metrics, self.zones, self.hourly_spine, self.hourly_mobility_summary, self.zone_performance, self.od_flow,
        )

    @cached_property
    def data_quality_anomalies(self) -> DataFrame:
        return quality.data_quality_anomalies(self.trips_clean)

    @cached_property
    def executive_mobility(self) -> DataFrame:
        return temporal.executive_mobility(self.trip_metrics, self.hourly_mobility_summary)

    @cached_property
    def temporal_demand(self) -> DataFrame:
        return temporal.temporal_demand(self.hourly_mobility_summary)

    @cached_property
    def geographic_performance(self) -> DataFrame:
        return geography.geographic_performance(self.zone_performance)

    @cached_property
    def fare_payment_analysis(self) -> DataFrame:
        return payments.fare_payment_analysis(self.trip_metrics)

    @cached_property
    def weather_transit_analysis(self) -> DataFrame:
        return weather.weather_transit_analysis(self.hourly_mobility_summary)

    @cached_property
    def statistical_analysis(self) -> DataFrame:
        return regression_base.statistical_analysis(self.hourly_mobility_summary)

    def with_staged_trips(self, staged_trips: DataFrame) -> "Warehouse":
        """The same warehouse over an already written staging table of trips."""
        return Warehouse(self.spark, replace(self.inputs, taxi_trips=staged_trips), self.config)

    def measured(self, *relations: str) -> DataFrame:
        """One row with the measures of `plans.checks` of the relations: those observed when a layer was written are at
        hand, the others are aggregated from their relation."""
        known = {k: v for name in relations for k, v in self.observed.get(name, {}).items()}
        schema = ", ".join(f"{k} bigint" for k in known)
        parts = [self.spark.createDataFrame([tuple(known.values())], schema)] if known else []
        for name in relations:
            if name not in self.observed:
                relation = self.inputs.taxi_trips if name == "staged" else getattr(self, name)
                parts.append(relation.agg(*checks.aggregates(name)))
        return side_by_side(*parts)

    def _observing(self, name: str, observations: dict[str, Observation]) -> DataFrame:
        """The relation, which reports its measures while it is written. Trips report theirs as they pass through the
        staged, the clean and the derived form, so all trip measures come from the one write of the trips."""

        def noted(df: DataFrame, relation: str) -> DataFrame:
            if relation not in checks.MEASURES:
                return df
            observations[relation] = Observation(relation)
            return df.observe(observations[relation], *checks.aggregates(relation))

        df = getattr(self, name)
        if name != "trips_clean":
            return noted(df, name)
        clean = noted(trips.taxi_trips_clean(noted(self.inputs.taxi_trips, "staged"), self.config), name)
        return noted(trips.with_economics(clean, self.config), "trip_metrics").select(*df.columns)

    def build(self, root: str, layers: tuple[str, ...] = LAYERS) -> "Warehouse":
        """Full refresh: write the layers wave by wave and return a warehouse reading them.

        Later layers read the written parquet, so trips are derived once and a lost executor only
        repeats work since the previous wave. What the checks need to know of a layer is observed by
        its write.
        """
        built = Warehouse(self.spark, self.inputs, self.config)
        for wave in WAVES:
            frames = {name: getattr(built, name) for name in wave if name in layers}
            observations: dict[str, Observation] = {}
            watched = {name: built._observing(name, observations) for name in frames}
            with with_settings(self.spark, WRITE_SETTINGS), ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
                list(pool.map(lambda item: _write_layer(root, *item), watched.items()))
            for name, df in frames.items():
                built._use_table(name, f"{root}/{name}", df)
            built.observed |= {name: dict(o.get) for name, o in observations.items()}
        return built

    def _use_table(self, name: str, path: str, like: DataFrame) -> None:
        # Column order is fixed by the relation, not by the partition layout on disk.
        self.__dict__[name] = self.spark.read.schema(like.schema).parquet(path).select(*like.columns)
        self.written.add(name)

    @classmethod
    def open(cls, spark: SparkSession, inputs: StagedInputs, root: str, config: MobilityConfig = DEFAULT):
        """A warehouse reading layers written earlier by `build`."""
        opened = cls(spark, inputs, config)
        for name in (n for n in LAYERS if n not in VIEWS):
            opened._use_table(name, f"{root}/{name}", getattr(opened, name))
        return opened
