"""One ingest run: new actuals, forecasts, and the deltas made of both."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.config import MetricConfig
from tidewatch.operators.actuals import build_points, current_values, describe_source
from tidewatch.operators.deltas import POINT
from tidewatch.operators.forecast import forecast
from tidewatch.operators.grid import fetch_ranges, history_grid, missing_periods
from tidewatch.operators.versions import merge_versions, new_versions
from tidewatch.plans.refresh import mark_pending, refresh_deltas
from tidewatch.schemas import ACTUALS, FORECASTS
from tidewatch.session import scratch, stored
from tidewatch.sources.tables import BUCKETS, Part, in_parts, month_of, parts_of, read_partitioned, versions_table


def fetch_actuals(spark: SparkSession, configs: Iterable[MetricConfig], read: Callable[[MetricConfig], DataFrame],
                  table: DataFrame, as_of: datetime, delta_load: bool = True, **options) -> DataFrame:
    """Points to merge: all of them, or those of missing and refetched periods."""
    configs = list(configs)
    if not delta_load:
        return build_points(spark, configs, read, as_of, **options)
    existing = current_values(table, columns=("config_name", "timestamp"))
    missing = stored(missing_periods(history_grid(spark, configs, as_of), existing, configs, as_of), "missing")
    ranges = fetch_ranges(missing, [cfg for cfg in configs if not cfg.source_sql])
    return build_points(spark, configs, read, as_of, missing, ranges, **options)


@dataclass(frozen=True)
class IngestRun:
    """What a run wrote: months by config, and points it had to reject because they have no timestamp."""

    actuals: list[Part]
    forecasts: list[Part]
    deltas: list[Part]
    rejected: dict[str, int]


def merge_points(spark: SparkSession, path: str, points: DataFrame, configs: list[MetricConfig], schema: T.StructType,
                 as_of: datetime, noted: Callable[[list[Part]], None] = lambda parts: None) -> tuple[list[Part], int]:
    """Merge points into the versions under ``path``: the configs and months they fall into, and the number rejected.

    The stored side is neither shuffled nor copied: its buckets meet the points of their keys, and a task writes the buckets it
    read.  What describes a config stays out of the shuffle of the points and is added to the rows that are inserted.
    Replaced are whole partitions of a config and month, through a folder of the run's own.
    """
    narrow = [name for name in (*POINT, "forecast_method", "value") if name in schema.names]
    rows = new_versions(describe_source(points, configs), as_of).select("key", *narrow)
    fresh = stored(rows, "incoming")
    rejected = fresh.filter(F.col("timestamp").isNull()).count()
    touched = parts_of(fresh)
    if touched:
        noted(touched)
        table = versions_table(spark, path, schema)
        dealt = fresh.filter(F.col("timestamp").isNotNull()).repartition(BUCKETS, "key")
        merged = merge_versions(spark.table(table).filter(in_parts(touched)).select(*schema.names), dealt, as_of,
                                describe=lambda inserted: describe_source(inserted, configs))
        _replace(merged.withColumns({"config": F.col("config_name"), "month": month_of("timestamp")}), table)
    return touched, rejected


def _replace(rows: DataFrame, table: str) -> None:
    rows.write.insertInto(table, overwrite=True)


def ingest_run(spark: SparkSession, configs: Iterable[MetricConfig], read: Callable[[MetricConfig], DataFrame],
               thresholds: DataFrame, descriptions: DataFrame, root: str, as_of: datetime, delta_load: bool = True,
               forecast_from: str | datetime | None = None, forecast_to: datetime | None = None, **options) -> IngestRun:
    """Fetch, merge, forecast, merge, refresh deltas; tables live under ``root``.

    All configs run together.  Running it again with the same ``as_of`` and the same sources changes nothing, and finishes a
    run that broke off.  Runs of different configs may overlap on one ``root``: each replaces partitions of its own configs
    only.  Two runs of one config follow each other.
    """
    configs = list(configs)
    names = [cfg.name for cfg in configs]
    actuals_path, forecasts_path = f"{root}/actuals", f"{root}/forecasts"

    def held() -> DataFrame:
        table = read_partitioned(spark, actuals_path, ACTUALS, ("config", "month"))
        return table.filter(F.col("config").isin(names))

    def noted(parts: list[Part]) -> None:
        mark_pending(spark, root, parts)

    with scratch(spark, "ingest"):
        points = fetch_actuals(spark, configs, read, held(), as_of, delta_load, **options)
        actual_parts, lost_actuals = merge_points(spark, actuals_path, points, configs, ACTUALS, as_of, noted)
        training = current_values(held(), columns=("config_name", "dimension_split_value", "timestamp", "value"))
        predicted = forecast(training, configs, as_of, forecast_from, forecast_to)
        forecast_parts, lost_forecasts = merge_points(spark, forecasts_path, predicted, configs, FORECASTS, as_of, noted)
        deltas = refresh_deltas(spark, root, names, thresholds, descriptions, as_of)
    return IngestRun(actual_parts, forecast_parts, deltas, {"actuals": lost_actuals, "forecasts": lost_forecasts})
