from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.config import MetricConfig
from tidewatch.operators.actuals import current_values, describe_source
from tidewatch.operators.versions import OPEN_END, merge_versions, new_versions, require_unique, tombstone

CFG = MetricConfig(name="m", source_forecast_column_sql="SUM(x)", dimension_split="d", source_sql="SELECT 1")
POINT = "config_name string, timestamp timestamp, dimension_split_value string, value double"
T1, T2, T3 = datetime(2024, 1, 10), datetime(2024, 1, 11), datetime(2024, 1, 12)
DAY = datetime(2024, 1, 1)


def rows(spark, as_of, *points):
    frame = spark.createDataFrame([("m", DAY, dim, value) for dim, value in points], POINT)
    return new_versions(describe_source(frame, [CFG]), as_of)


def view(table):
    return sorted(tuple(r) for r in table.select(
        "dimension_split_value", F.coalesce("value", F.lit(-1.0)), "valid_from", "valid_to", "is_latest").collect())


def test_new_same_changed_and_gone(spark):
    table = rows(spark, T1, ("same", 1.0), ("changed", 1.0), ("gone", 1.0))
    merged = merge_versions(table, rows(spark, T2, ("same", 1.0), ("changed", 2.0), ("new", 1.0)), T2)
    assert view(merged) == [
        ("changed", 1.0, T1, T2, False), ("changed", 2.0, T2, OPEN_END, True),
        ("gone", 1.0, T1, OPEN_END, True), ("new", 1.0, T2, OPEN_END, True), ("same", 1.0, T1, OPEN_END, True)]


def test_closed_versions_never_change(spark):
    table = rows(spark, T1, ("a", 1.0))
    for as_of, value in ((T2, 2.0), (T3, 1.0)):
        table = merge_versions(table, rows(spark, as_of, ("a", value)), as_of)
    assert view(table) == [("a", 1.0, T1, T2, False), ("a", 1.0, T3, OPEN_END, True), ("a", 2.0, T2, T3, False)]


def test_merge_is_idempotent(spark):
    table = merge_versions(rows(spark, T1, ("a", 1.0)), rows(spark, T2, ("a", 2.0), ("b", None)), T2)
    again = merge_versions(table, rows(spark, T3, ("a", 2.0), ("b", None)), T3)
    assert view(again) == view(table)


def test_missing_value_can_be_filled(spark):
    merged = merge_versions(rows(spark, T1, ("a", None)), rows(spark, T2, ("a", 5.0)), T2)
    assert view(merged) == [("a", -1.0, T1, T2, False), ("a", 5.0, T2, OPEN_END, True)]


def test_duplicate_keys_fail(spark):
    with pytest.raises(Exception, match="duplicate key"):
        require_unique(rows(spark, T1, ("a", 1.0), ("a", 2.0))).collect()


def test_key_parts_do_not_run_together(spark):
    keys = [r.key for r in rows(spark, T1, ("ab", 1.0), ("a", 1.0)).collect()]
    assert len(set(keys)) == 2


def test_reader_skips_placeholders_and_missing_values(spark):
    frame = spark.createDataFrame(
        [("m", DAY, "a", 1.0), ("m", DAY, "b", None), ("m", datetime(1979, 1, 1), "c", 1.0)], POINT)
    table = new_versions(describe_source(frame, [CFG]), T1)
    assert current_values(table, "m", "d", ["dimension_split_value"]).collect() == [("a",)]
    assert tombstone(table, "m").filter("is_latest").isEmpty()
    assert tombstone(table, "other").filter("is_latest").count() == 3
