import math
import random
import statistics
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest

from tidewatch.config import MetricConfig
from tidewatch.functions.decompose import next_value
from tidewatch.operators import rolling
from tidewatch.operators.forecast import forecast, training_rows
from tidewatch.operators.grid import fetch_ranges, forecast_bounds, history_grid, missing_periods
from tidewatch.operators.rolling import Statistic, needed_history, rolling_statistics

POINT = "config_name string, timestamp timestamp, dimension_split_value string, value double"
START = datetime(2024, 1, 1)
NOW = datetime(2024, 3, 1, 7)


def config(**more):
    base = {"name": "m", "source_forecast_column_sql": "SUM(x)", "history_start": "2024-01-01"}
    return MetricConfig(**{**base, **more})


def series(spark, gaps=True, seed=1):
    """Two series with gaps, one starting late, one with a single value."""
    random.seed(seed)
    rows = [("m", START + timedelta(days=i), "a", round(random.gauss(0, 10), 2)) for i in range(55)
            if not gaps or random.random() > 0.3]
    rows += [("m", START + timedelta(days=i), "b", float(i)) for i in range(20, 60)]
    rows += [("m", START + timedelta(days=59), "late", 1.0)]
    return rows, spark.createDataFrame(rows, POINT)


FUNCTIONS = {"mean": statistics.fmean, "median": statistics.median, "max": max, "min": min, "sum": math.fsum}


def brute_force(rows, cfg, first, total, period=timedelta(days=1)):
    found = {}
    for dim in {r[2] for r in rows}:
        values = sorted((r[1], r[3]) for r in rows if r[2] == dim)
        for i in range(total):
            when = first + i * period
            known = [v for t, v in values if t < when]
            for method, body in cfg.algorithms.items():
                width = body["parameters"]["sliding_window"]
                if len(known) >= width:
                    found[(dim, when, method)] = round(FUNCTIONS[method](known[-width:]), 6)
    return found


@pytest.mark.parametrize("start", ["2024-01-01", "10 days"])
def test_windows_match_brute_force(spark, start):
    rows, points = series(spark)
    cfg = config(algorithms={m: {"parameters": {"sliding_window": n}} for m, n in
                             zip(FUNCTIONS, (7, 5, 3, 4, 10))})
    first, total = forecast_bounds(cfg, NOW, start)
    got = {(r.dimension_split_value, r.timestamp, r.forecast_method): round(r.value, 6)
           for r in forecast(points, [cfg], NOW, start=start).collect()}
    assert got == brute_force(rows, cfg, first, total)


def test_long_grid_is_generated_in_slices(spark, monkeypatch):
    rows, points = series(spark)
    cfg = config(algorithms={"mean": {"parameters": {"sliding_window": 3}}})
    first, total = forecast_bounds(cfg, NOW, "2024-01-01")
    monkeypatch.setattr(rolling, "_SLICE", 7)
    got = {(r.dimension_split_value, r.timestamp, "mean"): round(r._s, 6) for r in rolling_statistics(
        points, [Statistic("_s", "mean", 3)], first, total, "day").collect() if r._s is not None}
    assert got == brute_force(rows, cfg, first, total)


def test_history_is_cut_to_what_is_needed(spark):
    _, points = series(spark, gaps=False)
    kept = needed_history(points, datetime(2024, 2, 20), 3)
    counts = {r[0]: r[1] for r in kept.groupBy("dimension_split_value").count().collect()}
    assert counts == {"a": 3 + 5, "b": 3 + 10, "late": 1}
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_constant_needs_no_history_and_unknown_method_gives_nothing(spark):
    _, points = series(spark)
    cfg = config(algorithms={"constant_value": {"parameters": {"value": 0.5}}, "oracle": {}})
    rows = forecast(points, [cfg], NOW, start="3 days").collect()
    assert len(rows) == 3 * 4 and {r.value for r in rows} == {0.5}
    both = config(algorithms={"constant_value": {"parameters": {"value": 0.5}},
                              "mean": {"parameters": {"sliding_window": 2}}})
    assert forecast(points, [both], NOW, start="3 days").filter("forecast_method = 'constant_value'").count() == 12


def test_negative_forecasts_are_replaced_where_asked(spark):
    points = spark.createDataFrame([("m", START + timedelta(days=i), "a", v) for i, v in
                                    enumerate([4.0, 2.0, -3.0, -5.0, -7.0])], POINT)
    parameters = {"mean": ("zero", 2), "min": ("median", 2), "max": (None, 2)}
    cfg = config(algorithms={m: {"parameters": {"sliding_window": n, "replace_negative_forecasts_by": by}}
                             for m, (by, n) in parameters.items()})
    values = {r.forecast_method: r.value for r in
              forecast(points, [cfg], datetime(2024, 1, 6), start="2024-01-06").collect()}
    assert values == {"mean": 0.0, "min": -3.0, "max": -5.0}


def test_training_rows(spark):
    points = spark.createDataFrame(
        [("m", START, None, 1.0), ("m", START, "old", 1.0), ("n", START, "old", 1.0), ("m", START, "a", None)], POINT)
    kept = training_rows(points, [config(deprecated_dims=["old"]), config(name="n")])
    assert sorted((r[0], r[1]) for r in kept.collect()) == [("m", "NA"), ("n", "old")]


def test_no_training_data_gives_no_forecasts(spark):
    cfg = config(algorithms={"mean": {"parameters": {"sliding_window": 2}}, "constant_value": {"parameters": {"value": 1}},
                             "mstl": {"parameters": {"season_length": [7]}}})
    assert forecast(spark.createDataFrame([], POINT), [cfg], NOW).isEmpty()


def test_forecast_bounds():
    assert forecast_bounds(config(), NOW) == (START, 61)
    assert forecast_bounds(config(forecast_start="14 days"), NOW)[0] == datetime(2024, 2, 16)
    assert forecast_bounds(config(forecast_start="14 days"), NOW, start="7 days") == (datetime(2024, 2, 23), 8)
    hourly = config(period_length="hour")
    assert forecast_bounds(hourly, NOW) == (datetime(2024, 2, 26, 13), 91)


def test_decomposition_follows_trend_and_seasons():
    def value(i):
        return 100 + 0.05 * i + 20 * math.sin(2 * math.pi * i / 7) + 10 * math.cos(2 * math.pi * i / 30)

    history = np.array([value(i) for i in range(365)])
    assert next_value(history, [7, 30]) == pytest.approx(value(365), abs=3)
    assert next_value(history, [30, 7]) == next_value(history, [7, 30])
    noisy = history + np.random.default_rng(1).normal(0, 1, 365)
    assert next_value(noisy, [7, 30]) == pytest.approx(value(365), abs=6)
    assert next_value(np.full(40, 5.0), [7]) == pytest.approx(5.0)
    assert math.isfinite(next_value(np.arange(9.0), [365.25]))


def test_decomposed_forecast_needs_two_of_the_first_season(spark):
    rows = [("m", START + timedelta(days=i), "a", 10.0 + i % 7) for i in range(40)]
    points = spark.createDataFrame(rows, POINT)
    cfg = config(algorithms={"mstl": {"parameters": {"season_length": [14, 7]}}})
    got = forecast(points, [cfg], datetime(2024, 2, 9), start="2024-01-01").collect()
    assert sorted(r.timestamp for r in got) == [START + timedelta(days=i) for i in range(28, 40)]
    by_day = {r.timestamp: r.value for r in got}
    assert by_day[START + timedelta(days=35)] == pytest.approx(10.0, abs=0.5)


def test_missing_and_refetched_periods(spark):
    cfg = config(period_length="day")
    grid = history_grid(spark, [cfg], datetime(2024, 1, 10, 5))
    existing = spark.createDataFrame([("m", START + timedelta(days=i)) for i in (0, 1, 2, 5, 8, 9)],
                                     "config_name string, timestamp timestamp")

    def days(*configs):
        return sorted(r.timestamp.day for r in missing_periods(grid, existing, configs, datetime(2024, 1, 10, 5)).collect())

    assert days(cfg) == [4, 5, 7, 8]
    assert days(replace(cfg, refetch_recent_days=2)) == [4, 5, 7, 8, 9, 10]
    nothing = existing.filter("false")
    assert missing_periods(grid, nothing, [replace(cfg, refetch_recent_days=2)], datetime(2024, 1, 10)).count() == 10


def test_fetch_ranges(spark):
    cfg, monthly = config(), config(name="n", period_length="month")
    missing = spark.createDataFrame(
        [("m", START + timedelta(days=i)) for i in (0, 1, 2, 5, 8, 9)] + [("n", datetime(2024, 1, 1)), ("n", datetime(2024, 2, 1))],
        "config_name string, timestamp timestamp")
    assert fetch_ranges(missing, [cfg, monthly]) == {
        "m": [(datetime(2024, 1, 1), datetime(2024, 1, 4)), (datetime(2024, 1, 6), datetime(2024, 1, 7)),
              (datetime(2024, 1, 9), datetime(2024, 1, 11))],
        "n": [(datetime(2024, 1, 1), datetime(2024, 3, 1))]}
    scattered = [START + timedelta(days=2 * i) for i in range(300)] + [START + timedelta(days=2000)]
    many = spark.createDataFrame([("m", at) for at in scattered], "config_name string, timestamp timestamp")
    ranges = fetch_ranges(many, [cfg])["m"]
    assert len(ranges) <= 64 and all(any(low <= at < high for low, high in ranges) for at in scattered)
    assert all(high <= scattered[-2] + timedelta(days=1) or low >= scattered[-1] for low, high in ranges)  # the wide gap is not read
    assert fetch_ranges(missing.filter("false"), [cfg]) == {"m": []}


@pytest.mark.parametrize("name", ["mean", "median", "min", "max", "sum"])
def test_statistics_of_prefixes_of_long_series(spark, name):
    import statistics

    from tidewatch.operators.rolling import prefix_statistics
    first = datetime(2020, 1, 1)
    values = [((k * 7919) % 1009) - 400.0 for k in range(1500)]
    train = spark.createDataFrame([("m", dim, first + timedelta(hours=k), v) for dim in "ab" for k, v in enumerate(values) if dim == "a" or k % 3],
                                  "config_name string, dimension_split_value string, timestamp timestamp, value double")
    places = [0, 1, 2, 7, 8, 500, 1000, 1499, 1500, 2000]
    asked = spark.createDataFrame([("m", "a", first + timedelta(hours=k)) for k in places] + [("m", "none", first)],
                                  "config_name string, dimension_split_value string, timestamp timestamp")
    plain = {"mean": statistics.fmean, "median": statistics.median, "min": min, "max": max, "sum": sum}[name]
    got = {(r.dimension_split_value, r.timestamp): r.value for r in prefix_statistics(train, asked, name).collect()}
    assert got == pytest.approx({("a", first + timedelta(hours=k)): plain(values[:k]) for k in places if k})


def test_only_negative_periods_ask_for_a_replacement(spark, monkeypatch):
    from tidewatch.operators import forecast as fc
    points = spark.createDataFrame([("m", "a", datetime(2024, 1, d), float(v)) for d, v in enumerate([5, -9, 4, 3, 8, -20, 2], 1)],
                                   "config_name string, dimension_split_value string, timestamp timestamp, value double")
    cfg = MetricConfig(name="m", source_forecast_column_sql="x", history_start="2024-01-01", algorithms={
        "min": {"parameters": {"sliding_window": 2, "replace_negative_forecasts_by": "median"}}})
    seen = []

    def watched(train, asked, name):
        seen.extend(r.timestamp.day for r in asked.collect())
        return fc_prefix(train, asked, name)
    fc_prefix = fc.prefix_statistics
    monkeypatch.setattr(fc, "prefix_statistics", watched)
    got = {r.timestamp.day: r.value for r in fc.forecast(points, [cfg], datetime(2024, 1, 8), end=datetime(2024, 1, 8)).collect()}
    assert sorted(seen) == [3, 4, 7, 8]
    assert got == {3: -2.0, 4: 4.0, 5: 3.0, 6: 3.0, 7: 3.5, 8: 3.0}
