"""ratewatch: finds unusual movements in daily business rates, on Spark."""

from ratewatch.clock import Clock
from ratewatch.plans.detect import detect
from ratewatch.plans.job import run
from ratewatch.plans.late import DailyStore
from ratewatch.plans.rolling import rolling_detect
from ratewatch.plans.sliding import BaselineState
from ratewatch.sources.tables import Tables, from_catalog, from_files
from ratewatch.specs import ACCEPTANCE, DEFAULT_SPECS, DISPUTE, FRAUD, MetricSpec

__all__ = [
    "ACCEPTANCE",
    "DEFAULT_SPECS",
    "DISPUTE",
    "FRAUD",
    "BaselineState",
    "Clock",
    "DailyStore",
    "MetricSpec",
    "Tables",
    "detect",
    "from_catalog",
    "from_files",
    "rolling_detect",
    "run",
]
