"""Period grids: what should exist, what is missing, what to forecast."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.config import MetricConfig
from tidewatch.functions.periods import (
    add_periods, count_periods, date_or_period, floor_period, period_at, timestamp_literal,
)

DEFAULT_HORIZON = 90
_SLICE = 10_000  # periods generated per exploded row


def history_grid(spark: SparkSession, configs: Iterable[MetricConfig], as_of: datetime) -> DataFrame:
    """``(config_name, timestamp)`` for every period from history start to now.

    ``range`` is generated in parallel, so a grid of seconds over years is
    never built as one array on one task.
    """
    parts = []
    for cfg in configs:
        start = cfg.grid_from(as_of)
        total = count_periods(start, as_of, cfg.period_length)
        parts.append(spark.range(total).select(
            F.lit(cfg.name).alias("config_name"),
            period_at(start, F.col("id"), cfg.period_length).alias("timestamp"),
        ))
    return reduce(DataFrame.unionByName, parts)


def missing_periods(grid: DataFrame, existing: DataFrame, configs: Iterable[MetricConfig], as_of: datetime) -> DataFrame:
    """Periods to fetch: absent from ``existing``, or inside the refetch window.

    ``existing`` holds ``(config_name, timestamp)`` of stored values; a period
    counts as present as soon as any dimension has it.  The refetch window
    only applies to configs that have stored values at all.
    """
    stored = existing.select("config_name", "timestamp").distinct()
    absent = grid.join(stored, ["config_name", "timestamp"], "left_anti")
    refetched = [cfg for cfg in configs if cfg.refetch_recent_days > 0]
    if not refetched:
        return absent
    cutoff = F.lit(None).cast("timestamp")
    for cfg in refetched:
        start = floor_period(add_periods(as_of, -cfg.refetch_recent_days, "day"), cfg.period_length)
        cutoff = F.when(F.col("config_name") == cfg.name, timestamp_literal(start)).otherwise(cutoff)
    recent = grid.filter(F.col("timestamp") >= cutoff).join(
        stored.select("config_name").distinct(), "config_name", "left_semi")
    return absent.unionByName(recent).distinct()


def retained_periods(grid: DataFrame, existing: DataFrame, configs: Iterable[MetricConfig], as_of: datetime) -> DataFrame:
    """Stored periods that will not be fetched again (the complement of the above)."""
    stored = existing.select("config_name", "timestamp").distinct()
    return stored.join(missing_periods(grid, existing, configs, as_of), ["config_name", "timestamp"], "left_anti")


def joined_ranges(ranges: Iterable[tuple[datetime, datetime]]) -> list[tuple[datetime, datetime]]:
    """The same instants in ranges that neither overlap nor touch."""
    found: list[tuple[datetime, datetime]] = []
    for first, end in sorted(ranges):
        if found and first <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((first, end))
    return found


PARTS = 64  # of the time between a config's first and last missing period


def fetch_ranges(missing: DataFrame, configs: Iterable[MetricConfig]) -> dict[str, list[tuple[datetime, datetime]]]:
    """Missing periods per config as ``[start, end)`` ranges for scan pruning.

    The time from a config's first to its last missing period is cut into ``PARTS`` equal parts, and each part is read
    from its first to its last missing period.  So only gaps narrower than a part are read across, however many there
    are, and one more missing period moves at most the range of its own part.  The exact semi join on the missing
    periods follows.  What reaches the driver has ``PARTS`` rows for each config at most.
    """
    outer = missing.groupBy("config_name").agg(F.min("timestamp").alias("_low"), F.max("timestamp").alias("_high"))
    part = F.expr(f"(unix_micros(timestamp) - unix_micros(_low)) * {PARTS} div (unix_micros(_high) - unix_micros(_low) + 1)")
    parts = missing.join(outer, "config_name").groupBy("config_name", part.alias("_part")).agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    spans: dict[str, list[tuple[datetime, datetime]]] = {}
    for row in parts.collect():
        spans.setdefault(row["config_name"], []).append((row["first"], row["last"]))
    return {cfg.name: joined_ranges((first, add_periods(last, 1, cfg.period_length)) for first, last in spans.get(cfg.name, []))
            for cfg in configs}


def forecast_bounds(cfg: MetricConfig, as_of: datetime, start: str | datetime | None = None,
                    end: datetime | None = None) -> tuple[datetime, int]:
    """First period to forecast and the number of periods.

    The start is the run's, else the config's, else the last 90 periods;
    never before the history.
    """
    wanted = start or cfg.forecast_start or f"{DEFAULT_HORIZON} {cfg.period_length}s"
    first = floor_period(max(date_or_period(wanted, as_of), cfg.history_from(as_of)), cfg.period_length)
    return first, count_periods(first, end or as_of, cfg.period_length)


def explode_periods(frame: DataFrame, start: datetime, total: int, period: str,
                    keep: list[str]) -> DataFrame:
    """Repeat every row once per period, adding ``period_index`` and ``timestamp``.

    Generated in slices so that a long grid is not one huge array per row.
    """
    slices = F.sequence(F.lit(0).cast("long"), F.lit(max(total - 1, 0) // _SLICE).cast("long"))
    sliced = frame.select(*keep, F.explode(slices).alias("_slice"))
    first = F.col("_slice") * _SLICE
    last = F.least(first + _SLICE - 1, F.lit(total - 1))
    indexed = sliced.filter(F.lit(total > 0)).select(
        *keep, F.explode(F.sequence(first, last)).alias("period_index"))
    return indexed.withColumn("timestamp", period_at(start, F.col("period_index"), period))


def forecast_grid(frame: DataFrame, cfg: MetricConfig, as_of: datetime, start: str | datetime | None = None,
                  end: datetime | None = None) -> DataFrame:
    """Every ``(config_name, dimension_split_value)`` of ``frame`` times the periods to forecast."""
    first, total = forecast_bounds(cfg, as_of, start, end)
    keys = ["config_name", "dimension_split_value"]
    return explode_periods(frame.select(*keys).distinct(), first, total, cfg.period_length, keys)
