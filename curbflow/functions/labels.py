"""Code and band labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbflow.config import (
    CANONICAL_UNKNOWN_PAYMENT,
    PAYMENT_LABELS,
    BandScheme,
    MobilityConfig,
)


def first_match(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """Label of the first condition that holds."""
    head, *tail = cases
    chain = reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), tail, F.when(head[0], F.lit(head[1])))
    return chain if default is None else chain.otherwise(F.lit(default))


def payment_label(code: Column) -> Column:
    return first_match([(code == k, v) for k, v in PAYMENT_LABELS.items()], "Unknown")


def canonical_payment(code: Column) -> Column:
    """Codes with a label keep it; everything else, NULL included, folds into one code."""
    return F.when(code.isin(*PAYMENT_LABELS), code).otherwise(F.lit(CANONICAL_UNKNOWN_PAYMENT))


def band(value: Column, scheme: BandScheme) -> Column:
    below = [((value <= hi) if scheme.inclusive else (value < hi), name) for hi, name in scheme.bounds]
    missing = [(value.isNull(), scheme.missing)] if scheme.missing else []
    return first_match(missing + below, scheme.top)


def precipitation_band(value: Column, scheme: BandScheme) -> Column:
    return F.when(value == 0, F.lit("Dry")).otherwise(band(value, scheme))


def airport_direction(pickup: Column, dropoff: Column) -> Column:
    return first_match(
        [
            (pickup & dropoff, "Airport to Airport"),
            (pickup, "Airport Pickup"),
            (dropoff, "Airport Dropoff"),
        ],
        "Non-Airport",
    )


def airport_category(pickup: Column, dropoff: Column, config: MobilityConfig) -> Column:
    """Directional category; the first rule that holds wins."""
    jfk, lga = config.jfk_zone, config.laguardia_zone
    return first_match(
        [
            ((pickup == jfk) & (dropoff == jfk), "JFK to JFK"),
            ((pickup == lga) & (dropoff == lga), "LaGuardia to LaGuardia"),
            ((pickup == jfk) & (dropoff == lga), "JFK to LaGuardia"),
            ((pickup == lga) & (dropoff == jfk), "LaGuardia to JFK"),
            (pickup == jfk, "JFK Pickup"),
            (dropoff == jfk, "JFK Dropoff"),
            (pickup == lga, "LaGuardia Pickup"),
            (dropoff == lga, "LaGuardia Dropoff"),
        ],
        "Non-Airport",
    )


def distance_bucket(miles: Column) -> Column:
    return first_match(
        [(miles > 500, ">500 miles"), (miles > 100, "100-500 miles"), (miles > 50, "50-100 miles")],
        "<=50 miles",
    )
