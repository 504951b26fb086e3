"""Tidewatch: metric monitoring as Spark jobs.

Source tables become metric time series, the series are kept as versioned
history, forecast, compared with what was observed, and the comparison drives
an incident log.  Every step is a function from DataFrame to DataFrame.
"""

from tidewatch.config import MetricConfig, load_configs
from tidewatch.session import build_session

__all__ = ["MetricConfig", "build_session", "load_configs"]
