"""Parameters of the analysis. Relations receive a config; nothing is read from globals."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta


@dataclass(frozen=True)
class Period:
    """Half-open analysis period in local wall-clock time."""

    start: datetime = datetime(2024, 4, 1)
    end: datetime = datetime(2024, 7, 1)

    @property
    def hours(self) -> int:
        return int((self.end - self.start) / timedelta(hours=1))

    @property
    def last_hour(self) -> datetime:
        return self.end - timedelta(hours=1)


@dataclass(frozen=True)
class BandScheme:
    """Ordered upper bounds and the label below each; values past the last bound get `top`."""

    bounds: tuple[tuple[float, str], ...]
    top: str
    inclusive: bool
    missing: str | None


# Band edges and labels of the two weather schemes in use.
# Precipitation labels follow a separate "exactly zero is Dry" rule.
PRECIPITATION_COARSE = BandScheme(
    ((1.0, "Light Rain"), (5.0, "Moderate Rain")), "Heavy Rain", True, "Unknown"
)
PRECIPITATION_METEO = BandScheme(
    ((2.5, "Light Rain"), (7.6, "Moderate Rain")), "Heavy Rain", False, "Unknown"
)
TEMPERATURE_FINE = BandScheme(
    ((5.0, "Cold"), (15.0, "Cool"), (25.0, "Mild"), (32.0, "Warm")), "Hot", False, "Unknown"
)
TEMPERATURE_COARSE = BandScheme(
    ((5.0, "Cold"), (15.0, "Mild"), (25.0, "Warm")), "Hot", False, None
)

# Payment codes and labels. Every other code reads "Unknown".
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
UNKNOWN_PAYMENT_CODE = 0
CANONICAL_UNKNOWN_PAYMENT = 5

# Severity order of quality rules.
SEVERITIES = ("Critical", "High", "Medium", "Low")


@dataclass(frozen=True)
class MobilityConfig:
    period: Period = field(default_factory=Period)
    jfk_zone: int = 132
    laguardia_zone: int = 138
    long_trip_seconds: int = 86_400
    extreme_distance: float = 100.0
    high_passengers: int = 6
    test_share: float = 0.2
    minimum_model_rows: int = 500

    @property
    def airport_zones(self) -> tuple[int, int]:
        return (self.jfk_zone, self.laguardia_zone)


DEFAULT = MobilityConfig()
