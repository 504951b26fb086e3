"""Whole ingest runs over stored tables."""

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.config import MetricConfig, load_configs
from tidewatch.operators.actuals import aggregate_points, build_points
from tidewatch.plans.ingest import ingest_run
from tidewatch.schemas import ACTUALS, DESCRIPTIONS, FORECASTS, THRESHOLDS
from tidewatch.sources.tables import (
    read_channels, read_descriptions, read_partitioned, read_source, read_thresholds, write_partitioned,
)

EVENTS = "/root/testdata/sf0.001/events.parquet"
YAML = """
anomalies:
  per_type:
    source_dataset: warehouse
    source_table: events
    source_timestamp_column: ts
    source_timestamp_column_sql: ts
    source_forecast_column: value
    source_forecast_column_sql: COUNT(*)
    dimension_split: event_type
    history_start: "2024-01-01"
    refetch_recent_days: 1
    algorithms:
      median:
        parameters:
          sliding_window: 5
      constant_value:
        parameters:
          value: 7
  hourly:
    source_dataset: warehouse
    source_table: events
    source_timestamp_column_sql: ts
    source_forecast_column_sql: SUM(value)
    period_length: hour
    history_start: "20 days"
    algorithms:
      mean:
        parameters:
          sliding_window: 24
"""


def test_runs_build_on_each_other(spark, tmp_path):
    path = tmp_path / "config_dev.yaml"
    path.write_text(YAML)
    configs = list(load_configs(path).values())
    events = read_source(spark, EVENTS)
    limits = spark.createDataFrame([("per_type", "median", -0.5, 0.5, -0.2, 0.2)], THRESHOLDS)
    texts = spark.createDataFrame([("per_type", "about", None, None)], DESCRIPTIONS)
    root = str(tmp_path / "tables")
    first, second = datetime(2024, 1, 20, 14), datetime(2024, 1, 21, 9)

    def run(as_of):
        ingest_run(spark, configs, lambda cfg: events.filter(F.col("ts") < F.lit(as_of)), limits, texts, root, as_of)
        return {name: read_partitioned(spark, f"{root}/{name}", schema).select(*schema.names).withColumn(
                "valid_to", F.col("valid_to").cast("string")).toPandas()
                for name, schema in (("actuals", ACTUALS), ("forecasts", FORECASTS))}

    one = run(first)
    again = run(first)
    for name in one:
        order = ["key", "valid_from"]
        assert one[name].sort_values(order).reset_index(drop=True).equals(
            again[name].sort_values(order).reset_index(drop=True))
    two = run(second)
    actuals = two["actuals"]
    current = actuals[actuals.is_latest]
    assert current.key.is_unique and len(actuals) > len(current)
    # Only the refetched, restated part has closed versions.
    closed = actuals[~actuals.is_latest]
    assert set(closed.valid_to) == {str(second)} and closed.timestamp.min() >= datetime(2024, 1, 20)
    expected = aggregate_points(events.filter(F.col("ts") < F.lit(second)), [configs[0]], second).toPandas()
    per_type = current[current.config_name == "per_type"]
    merged = per_type.merge(expected, on=["timestamp", "dimension_split_value"], suffixes=("", "_e"))
    assert len(merged) == len(per_type) == len(expected)
    assert (merged.value == merged.value_e).all()
    deltas = spark.read.parquet(f"{root}/deltas")
    assert deltas.filter("forecast_timestamp > '2024-01-21 09:00:00'").isEmpty()
    assert deltas.filter("forecast_method = 'median' AND actual_timestamp IS NOT NULL").count() > 50
    assert {r[0] for r in deltas.select("month").distinct().collect()} <= {"2024-01", "__HIVE_DEFAULT_PARTITION__", None}


def test_shared_scan_reads_the_source_once(spark):
    events = read_source(spark, EVENTS)
    configs = [MetricConfig(name=n, source_table="events", source_timestamp_column_sql="ts", source_forecast_column_sql=v,
                            history_start="2024-01-01") for n, v in (("a", "COUNT(*)"), ("b", "MIN(value)"))]
    points = build_points(spark, configs, lambda cfg: events, datetime(2024, 2, 1))
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(ts" in plan
    assert points.count() == 2 * events.select(F.to_date("ts")).distinct().count()


def test_garbage_timestamps_and_null_dimensions(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5), "x", 1.0), (datetime(2024, 1, 1, 6), None, 2.0), (datetime(1970, 1, 1), "x", 9.0),
         (datetime(2150, 1, 1), "x", 9.0)], "ts timestamp, d string, value double")
    cfg = MetricConfig(name="m", source_timestamp_column_sql="ts", source_forecast_column_sql="SUM(value)",
                       dimension_split="d", history_start="1960-01-01")
    got = aggregate_points(rows, [cfg], datetime(2024, 2, 1)).collect()
    assert sorted((r.dimension_split_value, r.value) for r in got) == [("NA", 2.0), ("x", 1.0)]


def test_partitioned_table_replaces_only_its_months(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, at timestamp"
    write_partitioned(spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1)), (3, None)], schema), path, "at")
    write_partitioned(spark.createDataFrame([(4, datetime(2024, 2, 2))], schema), path, "at")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3, 4]
    write_partitioned(spark.createDataFrame([(5, datetime(2024, 3, 1))], schema), path, "at", mode="append")
    assert spark.read.parquet(path).count() == 4
    assert read_partitioned(spark, str(tmp_path / "absent"), ACTUALS).isEmpty()


def test_seeds(spark, tmp_path):
    (tmp_path / "thresholds_dev.csv").write_text(
        "config_name,forecast_method,critical_lower,critical_higher,warning_lower,warning_higher\nm,mean,,1,,\n")
    (tmp_path / "config_descriptions_dev.csv").write_text(
        'config_name,description,dq_dashboard_url,text_inject\nm,"One, ""two""",,\n')
    (tmp_path / "channels.csv").write_text(
        "config_name,environment,slack_channel_id,slack_channel_name,thread_timeout_hours\n,dev,C1,name,\n")
    assert read_thresholds(spark, str(tmp_path), "dev").collect() == [("m", "mean", None, 1.0, None, None)]
    assert read_descriptions(spark, str(tmp_path), "dev").collect() == [("m", 'One, "two"', None, None)]
    assert read_channels(spark, str(tmp_path / "channels.csv")).collect() == [(None, "dev", "C1", "name", None)]


def test_delta_load_reads_a_shared_source_once(spark):
    from datetime import datetime

    from tidewatch.config import MetricConfig
    from tidewatch.operators.actuals import build_points

    source = spark.createDataFrame([(datetime(2024, 1, d, 5), float(d)) for d in range(1, 11)], "ts timestamp, value double")
    configs = [MetricConfig(name=n, source_table="t", source_timestamp_column_sql="ts", source_forecast_column_sql=f"{f}(value)",
                            history_start="2024-01-01", period_length="day") for n, f in (("a", "SUM"), ("b", "MAX"))]
    wanted = {"a": [2, 3], "b": [3, 7]}
    missing = spark.createDataFrame([(n, datetime(2024, 1, d)) for n, days in wanted.items() for d in days],
                                    "config_name string, timestamp timestamp")
    ranges = {n: [(datetime(2024, 1, d), datetime(2024, 1, d + 1)) for d in days] for n, days in wanted.items()}
    reads = []
    points = build_points(spark, configs, lambda cfg: reads.append(cfg.name) or source, datetime(2024, 2, 1), missing, ranges)
    assert sorted((r.config_name, r.value) for r in points.collect()) == [("a", 2.0), ("a", 3.0), ("b", 3.0), ("b", 7.0)]
    assert len(reads) == 1
