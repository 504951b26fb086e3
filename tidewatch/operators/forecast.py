"""Forecast methods and their dispatch by name."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.config import MetricConfig
from tidewatch.functions.decompose import next_value
from tidewatch.functions.periods import add_periods
from tidewatch.operators.actuals import NULL_DIMENSION
from tidewatch.operators.grid import explode_periods, forecast_bounds, forecast_grid
from tidewatch.operators.rolling import SERIES, STATISTICS, Statistic, prefix_statistics, rolling_statistics
from tidewatch.session import ship_package, stored

FORECAST_COLUMNS = ["config_name", "dimension_split_value", "timestamp", "forecast_method", "value"]
CONSTANT, DECOMPOSED = "constant_value", "mstl"
METHODS = (*STATISTICS, CONSTANT, DECOMPOSED)


def training_rows(points: DataFrame, configs: Iterable[MetricConfig]) -> DataFrame:
    """Points to learn from: values present, dimensions named and not deprecated."""
    rows = points.filter(F.col("value").isNotNull()).select(
        "config_name", F.coalesce("dimension_split_value", F.lit(NULL_DIMENSION)).alias("dimension_split_value"),
        "timestamp", "value")
    for cfg in configs:
        if cfg.deprecated_dims:
            retired = (F.col("config_name") == cfg.name) & F.col("dimension_split_value").isin(*cfg.deprecated_dims)
            rows = rows.filter(~retired)
    return rows


def _of(train: DataFrame, names: Iterable[str]) -> DataFrame:
    return train.filter(F.col("config_name").isin(*names))


def _unpivot(frame: DataFrame, wanted: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """One row per method: each config gets its own ``(method, value)`` pairs."""
    def pairs(methods: list[tuple[str, Column]]) -> Column:
        return F.array(*[F.struct(F.lit(m).alias("forecast_method"), value.cast("double").alias("value"))
                         for m, value in methods])

    names = list(wanted)
    chosen = pairs(wanted[names[-1]])
    for name in names[:-1]:
        chosen = F.when(F.col("config_name") == name, pairs(wanted[name])).otherwise(chosen)
    return (frame.select(*SERIES, "timestamp", F.explode(chosen).alias("_p"))
            .select(*SERIES, "timestamp", "_p.forecast_method", "_p.value")
            .filter(F.col("value").isNotNull()))


def rolling_forecasts(train: DataFrame, configs: list[MetricConfig], as_of: datetime,
                      start: str | datetime | None = None, end: datetime | None = None) -> list[DataFrame]:
    """Windowed statistics; configs with the same grid share a pass over their values.

    The pass has every series of its configs on the grid, so a constant of
    such a config is one more column of it.
    """
    groups: dict[tuple, list[MetricConfig]] = {}
    for cfg in configs:
        if any(m in STATISTICS for m in cfg.algorithms):
            groups.setdefault((*forecast_bounds(cfg, as_of, start, end), cfg.period_length), []).append(cfg)
    parts = []
    for (first, total, period), members in groups.items():
        statistics, wanted = {}, {}
        for cfg in members:
            wanted[cfg.name] = methods = []
            for method in cfg.algorithms:
                if method in STATISTICS:
                    rows = int(cfg.parameters(method)["sliding_window"])
                    item = statistics.setdefault((method, rows), Statistic(f"{method}_{rows}", method, rows))
                    methods.append((method, F.col(item.alias)))
                elif method == CONSTANT:
                    methods.append((method, F.lit(float(cfg.parameters(method)["value"]))))
        older = any(first > cfg.grid_from(as_of) for cfg in members)
        wide = rolling_statistics(_of(train, list(wanted)), list(statistics.values()), first, total, period, older)
        parts.append(_unpivot(wide, wanted))
    return parts


def constant_forecast(train: DataFrame, cfg: MetricConfig, as_of: datetime, start: str | datetime | None = None,
                      end: datetime | None = None) -> DataFrame:
    """The same value for every period of every known series."""
    return forecast_grid(_of(train, [cfg.name]), cfg, as_of, start, end).select(
        *SERIES, "timestamp", F.lit(CONSTANT).alias("forecast_method"),
        F.lit(float(cfg.parameters(CONSTANT)["value"])).alias("value"))


def _blocks(series: DataFrame, total: int, tasks: int) -> int:
    """Into how many blocks of periods to split each series so that all tasks have work.

    Each block repeats the history of its series, so with many series there
    is one; no more than ``tasks`` of them are counted.
    """
    known = series.limit(tasks).count()
    return max(1, min(-(-tasks // max(known, 1)), -(-total // 4)))


def decomposed_forecast(train: DataFrame, cfg: MetricConfig, as_of: datetime, start: str | datetime | None = None,
                        end: datetime | None = None) -> DataFrame:
    """Multi-seasonal decomposition, refitted for every period on the values before it.

    A fit needs its whole series, which has one value per period of the
    configured history.  Series and blocks of consecutive periods are separate
    groups, so one long horizon is not one task.  The number of partitions is
    explicit: the rows are few, the work per row is not, and sizing by bytes
    would put all of it into one task.
    """
    ship_package(train.sparkSession)
    first, total = forecast_bounds(cfg, as_of, start, end)
    seasons = [float(s) for s in cfg.parameters(DECOMPOSED)["season_length"]]
    enough = 2 * seasons[0]
    own = _of(train, [cfg.name])
    tasks = 2 * train.sparkSession.sparkContext.defaultParallelism
    blocks = _blocks(own.select(*SERIES).distinct(), total, tasks)
    periods_per_task = max(1, -(-total // blocks))
    blocks = max(1, -(-total // periods_per_task))
    # A value is needed by every block that has a period after it.
    ends = F.array(*[F.lit(add_periods(first, min((b + 1) * periods_per_task, total) - 1, cfg.period_length))
                     for b in range(blocks)])
    wanted = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.col("timestamp") < F.get(ends, b))
    values = own.select(*SERIES, F.explode(wanted).alias("block"), "timestamp", "value", F.lit(False).alias("grid"))
    periods = explode_periods(own.select(*SERIES).distinct(), first, total, cfg.period_length, SERIES).select(
        *SERIES, (F.col("period_index") / periods_per_task).cast("int").alias("block"), "timestamp",
        F.lit(None).cast("double").alias("value"), F.lit(True).alias("grid"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        known = rows[~rows["grid"]].sort_values("timestamp")
        stamps, series = known["timestamp"].to_numpy(), known["value"].to_numpy(dtype=float)
        targets = np.sort(rows.loc[rows["grid"], "timestamp"].to_numpy())
        found = []
        for target, count in zip(targets, np.searchsorted(stamps, targets, side="left")):
            if count and count >= enough:
                found.append((target, next_value(series[:count], seasons)))
        result = pd.DataFrame(found, columns=["timestamp", "value"])
        result["timestamp"] = pd.to_datetime(result["timestamp"])
        result["value"] = result["value"].astype(float)
        for name in SERIES:
            result[name] = rows[name].iloc[0]
        return result[[*SERIES, "timestamp", "value"]]

    fitted = values.unionByName(periods).repartition(tasks, *SERIES, "block").groupBy(*SERIES, "block").applyInPandas(
        fit, "config_name string, dimension_split_value string, timestamp timestamp, value double")
    return fitted.select(*SERIES, "timestamp", F.lit(DECOMPOSED).alias("forecast_method"), "value")


def _replacement(cfg: MetricConfig, method: str) -> str | None:
    return cfg.parameters(method).get("replace_negative_forecasts_by")


def replace_negatives(forecasts: DataFrame, train: DataFrame, configs: list[MetricConfig]) -> DataFrame:
    """Replace negative forecasts where a method asks for it: by zero, or by a
    statistic of all values before the period, which is found for those periods only."""
    zero: Column = F.lit(False)
    by_statistic: dict[tuple[str, str], list[str]] = {}
    for cfg in configs:
        for method in cfg.algorithms:
            wanted = _replacement(cfg, method)
            if wanted == "zero":
                zero = zero | ((F.col("config_name") == cfg.name) & (F.col("forecast_method") == method))
            elif wanted in STATISTICS:
                by_statistic.setdefault((cfg.name, wanted), []).append(method)
    negative = F.col("value") < 0
    result = forecasts.withColumn("value", F.when(negative & zero, F.lit(0.0)).otherwise(F.col("value")))
    if not by_statistic:
        return result
    # Both the forecasts and the periods that ask for a replacement come from them: they are made once.
    result = stored(result, "forecasts")
    answers = []
    for (name, statistic), methods in by_statistic.items():
        asked = result.filter(negative & (F.col("config_name") == name) & F.col("forecast_method").isin(*methods))
        found = prefix_statistics(_of(train, [name]), asked.select(*SERIES, "timestamp").distinct(), statistic)
        answers.append(found.select(*SERIES, "timestamp", F.explode(F.array(*map(F.lit, methods))).alias("forecast_method"),
                                    F.col("value").alias("_instead")))
    joined = result.join(reduce(DataFrame.unionByName, answers), [*SERIES, "timestamp", "forecast_method"], "left")
    return joined.withColumn("value", F.when(negative & F.col("_instead").isNotNull(), F.col("_instead")).otherwise(F.col("value"))).drop("_instead")


def forecast(points: DataFrame, configs: Iterable[MetricConfig], as_of: datetime,
             start: str | datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Forecasts of all configs and methods as ``FORECAST_COLUMNS``.

    An unknown method yields nothing.  Grid rows are unique per series and
    method by construction, so no duplicate removal is needed.
    """
    configs = list(configs)
    train = training_rows(points, configs)
    parts = rolling_forecasts(train, configs, as_of, start, end)
    for cfg in configs:
        if CONSTANT in cfg.algorithms and not any(m in STATISTICS for m in cfg.algorithms):
            parts.append(constant_forecast(train, cfg, as_of, start, end))
        if DECOMPOSED in cfg.algorithms:
            parts.append(decomposed_forecast(train, cfg, as_of, start, end))
    if not parts:
        return train.filter(F.lit(False)).select(
            *SERIES, "timestamp", F.lit("").alias("forecast_method"), "value").select(*FORECAST_COLUMNS)
    combined = reduce(DataFrame.unionByName, [part.select(*FORECAST_COLUMNS) for part in parts])
    return replace_negatives(combined, train, configs).select(*FORECAST_COLUMNS)
