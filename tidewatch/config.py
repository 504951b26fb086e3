"""Metric definitions: what to aggregate, how to forecast, how to alert."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import datetime
from pathlib import Path
from typing import Any

from tidewatch.functions.periods import check_period, date_or_period, floor_period

THREAD, FLAT, FLAT_WITH_RESOLVE = "thread", "flat", "flat-with-resolve-replies"
MODES = (THREAD, FLAT, FLAT_WITH_RESOLVE)


@dataclass(frozen=True)
class MetricConfig:
    """One monitored metric.

    SQL fragments are Spark SQL.  Either the declared columns are used or
    ``source_sql``, a whole query returning ``timestamp``, ``value`` and
    ``dimension_split_value``.
    """

    name: str
    source_project: str = ""
    source_dataset: str = ""
    source_table: str = ""
    source_timestamp_column: str = ""
    source_timestamp_column_sql: str = ""
    source_forecast_column: str = ""
    source_forecast_column_sql: str = ""
    source_sql: str = ""
    source_filter_sql: str = ""
    dimension_split: str = ""
    period_length: str = "day"
    history_start: Any = "2012-01-01"
    forecast_start: Any = None
    refetch_recent_days: int = 0
    deprecated_dims: tuple[str, ...] = ()
    skip_newest_rows: int = 0
    algorithms: dict[str, dict[str, Any]] = field(default_factory=dict)
    aggregation_mode: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "period_length", check_period(self.period_length))
        object.__setattr__(self, "deprecated_dims", tuple(self.deprecated_dims or ()))
        if self.aggregation_mode is not None and self.aggregation_mode not in MODES:
            raise ValueError(f"{self.name}: aggregation_mode {self.aggregation_mode!r} is not one of {MODES}")
        if not self.source_sql and not self.source_forecast_column_sql:
            raise ValueError(f"{self.name}: needs source_sql or source_forecast_column_sql")

    @property
    def mode(self) -> str:
        """Message shape; by default from the split and the period."""
        if self.aggregation_mode:
            return self.aggregation_mode
        if self.dimension_split or self.source_sql:
            return THREAD
        return FLAT_WITH_RESOLVE if self.period_length in ("second", "minute", "hour") else FLAT

    def history_from(self, as_of: datetime) -> datetime:
        return date_or_period(self.history_start, as_of)

    def grid_from(self, as_of: datetime) -> datetime:
        return floor_period(self.history_from(as_of), self.period_length)

    def parameters(self, method: str) -> dict[str, Any]:
        return (self.algorithms.get(method) or {}).get("parameters") or {}


def config_from_mapping(name: str, mapping: dict[str, Any]) -> MetricConfig:
    """Build a definition from YAML content; unset fields keep their defaults."""
    known = {f.name for f in fields(MetricConfig)} - {"name"}
    values = {key: value for key, value in mapping.items() if key in known and value is not None}
    return MetricConfig(name=name, **values)


def load_configs(path: str | Path) -> dict[str, MetricConfig]:
    """Read ``anomalies: {name: {...}}`` from a YAML file."""
    import yaml

    content = yaml.safe_load(Path(path).read_text()) or {}
    return {name: config_from_mapping(name, body) for name, body in (content.get("anomalies") or {}).items()}


def config_file(folder: str | Path, environment: str) -> Path:
    return Path(folder) / f"config_{environment}.yaml"
