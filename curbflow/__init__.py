"""Urban mobility analytics as Spark jobs: staging, marts, checks and demand models."""

from curbflow.config import DEFAULT, MobilityConfig, Period
from curbflow.warehouse import Warehouse

__all__ = ["DEFAULT", "MobilityConfig", "Period", "Warehouse"]
