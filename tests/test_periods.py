from datetime import datetime

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from tidewatch.config import MetricConfig, config_from_mapping
from tidewatch.functions import periods as p

MOMENTS = st.datetimes(datetime(2012, 1, 1), datetime(2099, 12, 31))


@given(MOMENTS, st.sampled_from(p.PERIODS))
def test_floor_is_start_of_its_period(moment, period):
    start = p.floor_period(moment, period)
    assert start <= moment < p.add_periods(start, 1, period)
    assert p.floor_period(start, period) == start


@given(MOMENTS, st.integers(0, 400), st.sampled_from(p.PERIODS))
def test_count_matches_steps(moment, steps, period):
    start = p.floor_period(moment, period)
    assert p.count_periods(start, p.add_periods(start, steps, period), period) == steps + 1


def test_date_or_period():
    now = datetime(2024, 3, 31, 12)
    assert p.date_or_period("2021-01-01", now) == datetime(2021, 1, 1)
    assert p.date_or_period("2021-01-01 10:30:00", now) == datetime(2021, 1, 1, 10, 30)
    assert p.date_or_period("30 days", now) == datetime(2024, 3, 1, 12)
    assert p.date_or_period("1 month", now) == datetime(2024, 2, 29, 12)
    assert p.date_or_period("2 hours", now) == datetime(2024, 3, 31, 10)
    with pytest.raises(ValueError):
        p.date_or_period("soon", now)


def test_unknown_period_is_an_error():
    with pytest.raises(ValueError):
        MetricConfig(name="m", source_forecast_column_sql="COUNT(*)", period_length="fortnight")


def test_columns_agree_with_driver(spark):
    moments = [datetime(2024, 2, 29, 13, 5, 7, 9), datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 1, 7)]
    frame = spark.createDataFrame([(m,) for m in moments], "at timestamp")
    for period in p.PERIODS:
        starts = [row[0] for row in frame.select(p.truncate(F.col("at"), period)).collect()]
        assert starts == [p.floor_period(m, period) for m in moments]
        start = p.floor_period(moments[0], period)
        grid = spark.range(5).select(p.period_at(start, F.col("id"), period)).collect()
        assert [row[0] for row in grid] == [p.add_periods(start, i, period) for i in range(5)]


def test_mode_follows_split_and_period():
    def mode(**more):
        return MetricConfig(name="m", source_forecast_column_sql="COUNT(*)", **more).mode

    assert mode(dimension_split="d") == "thread"
    assert mode() == "flat"
    assert mode(period_length="hour") == "flat-with-resolve-replies"
    assert mode(aggregation_mode="thread") == "thread"


def test_mapping_keeps_defaults():
    cfg = config_from_mapping("m", {"source_forecast_column_sql": "SUM(x)", "refetch_recent_days": 14, "other": 1})
    assert (cfg.period_length, cfg.history_start, cfg.refetch_recent_days) == ("day", "2012-01-01", 14)
