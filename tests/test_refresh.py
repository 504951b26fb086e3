"""Runs that overlap, and deltas that are brought up to date instead of built anew."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.config import MetricConfig
from tidewatch.operators.actuals import describe_source
from tidewatch.operators.deltas import POINT, build_deltas
from tidewatch.operators.versions import merge_versions, new_versions
from tidewatch.plans import ingest, refresh
from tidewatch.schemas import ACTUALS, DESCRIPTIONS, FORECASTS, THRESHOLDS
from tidewatch.session import scratch
from tidewatch.sources.tables import BUCKETS, in_parts, parts_of, read_partitioned, versions_table

ROWS = "ts timestamp, kind string, amount double"
LIMITS = [("walk", "median", -0.4, 0.4, -0.1, 0.1), ("ride", "median", -0.3, 0.3, -0.05, 0.05)]


def config(name):
    return MetricConfig(name=name, source_table="trips", source_timestamp_column_sql="ts", source_forecast_column="amount",
                        source_forecast_column_sql="SUM(amount)", dimension_split="kind", history_start="2023-10-01",
                        algorithms={"median": {"parameters": {"sliding_window": 3}}}, refetch_recent_days=2)


def trips(spark, days):
    """Two kinds of trips; the second one pauses in November."""
    rows = [(datetime.fromordinal(datetime(2023, 10, 1).toordinal() + d), kind, float((d * 7 + len(kind) * 3) % 11 + 1))
            for d in range(days) for kind in ("car", "train") if kind == "car" or not 31 <= d < 61]
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture
def seeds(spark):
    return spark.createDataFrame(LIMITS, THRESHOLDS), spark.createDataFrame([("walk", "on foot", None, None)], DESCRIPTIONS)


def run(spark, names, days, root, as_of, seeds, **options):
    source = trips(spark, days)
    return ingest.ingest_run(spark, [config(n) for n in names], lambda cfg: source, *seeds, root, as_of,
                             forecast_from=datetime(2023, 10, 1), **options)


def whole(spark, root, seeds, as_of):
    """The deltas built from all stored versions."""
    versions = [read_partitioned(spark, f"{root}/{n}", s).select(*s.names) for n, s in (("actuals", ACTUALS), ("forecasts", FORECASTS))]
    return build_deltas(*versions, *seeds, as_of)


def same(spark, root, seeds, as_of):
    names = [c for c in whole(spark, root, seeds, as_of).columns if c != "delta_valid_from"]
    with scratch(spark, "whole"):
        expected = whole(spark, root, seeds, as_of).select(*names).collect()
    got = spark.read.parquet(f"{root}/deltas").select(*names).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_overlapping_runs_lose_nothing(spark, tmp_path, seeds, monkeypatch):
    """A whole run of another config between reading and replacing of each table."""
    root, as_of = str(tmp_path / "t"), datetime(2023, 10, 20, 12)
    replace, calls = ingest._replace, []

    def interrupted(rows, table):
        if not calls:
            calls.append(table)
            with monkeypatch.context() as plain:
                plain.setattr(ingest, "_replace", replace)
                run(spark, ["ride"], 20, root, as_of, seeds)
        replace(rows, table)
    monkeypatch.setattr(ingest, "_replace", interrupted)
    run(spark, ["walk"], 20, root, as_of, seeds)
    monkeypatch.setattr(ingest, "_replace", replace)
    assert calls
    for name, schema in (("actuals", ACTUALS), ("forecasts", FORECASTS)):
        rows = read_partitioned(spark, f"{root}/{name}", schema)
        counts = {r["config_name"]: r["count"] for r in rows.groupBy("config_name").count().collect()}
        assert set(counts) == {"walk", "ride"} and counts["walk"] == counts["ride"] > 0
    same(spark, root, seeds, as_of)


def test_refresh_builds_what_a_run_touched(spark, tmp_path, seeds):
    root = str(tmp_path / "t")
    first = run(spark, ["walk"], 85, root, datetime(2023, 12, 24, 12), seeds)
    assert {m for _, m in first.deltas} == {"2023-10", "2023-11", "2023-12"}
    same(spark, root, seeds, datetime(2023, 12, 24, 12))
    # a day more: one month is written
    as_of = datetime(2023, 12, 25, 12)
    second = run(spark, ["walk"], 86, root, as_of, seeds, forecast_to=as_of)
    assert {m for _, m in second.actuals} == {"2023-12"}
    same(spark, root, seeds, as_of)
    # the same again writes the newest month at most, and changes nothing
    again = ingest.refresh_deltas(spark, root, ["walk"], *seeds, as_of)
    assert {m for _, m in again} <= {"2023-12"}
    same(spark, root, seeds, as_of)


def test_a_changed_month_reaches_the_next_point_of_a_series(spark, tmp_path, seeds):
    """The last class of October changes: the first point of November starts or ends an anomaly now."""
    root, as_of = str(tmp_path / "t"), datetime(2023, 12, 24, 12)
    run(spark, ["walk"], 85, root, as_of, seeds)
    points = spark.createDataFrame([("walk", datetime(2023, 10, 31), "train", 900.0)],
                                   "config_name string, timestamp timestamp, dimension_split_value string, value double")
    refresh.mark_pending(spark, root, [("walk", "2023-10")])
    ingest.merge_points(spark, f"{root}/actuals", points, [config("walk")], ACTUALS, as_of)
    written = refresh.refresh_deltas(spark, root, ["walk"], *seeds, as_of)
    assert {("walk", "2023-10"), ("walk", "2023-11")} <= set(written)
    same(spark, root, seeds, as_of)


def test_followers_skip_months_without_points(spark):
    """October changes, November and December were built too, a series without points there goes on in January."""
    schema = "config_name string, _method string, _dimension string, month string, _end string"

    def ends(*rows):
        return spark.createDataFrame([("c", "m", series, month, end) for series, month, end in rows], schema)
    before = ends(("a", "10", "normal"), ("b", "10", "normal"), ("b", "11", "normal"), ("c", "10", "normal"), ("d", "11", "normal"))
    after = ends(("a", "10", "warning_lower"), ("b", "10", "warning_lower"), ("b", "11", "normal"), ("c", "10", "normal"))
    others = ends(("a", "01+", "normal"), ("a", "12+", "normal"), ("b", "02+", "normal"), ("c", "03+", "normal"), ("d", "12-", "normal"))
    # "01+" sorts before "10" and is no follower
    assert refresh._followers(before, after, others) in ([("c", "12+"), ("c", "12-")], [("c", "12-"), ("c", "12+")])


def test_settings_stale_configs_and_broken_runs(spark, tmp_path, seeds):
    root, as_of = str(tmp_path / "t"), datetime(2023, 10, 20, 12)
    run(spark, ["walk", "ride"], 20, root, as_of, seeds)
    # other thresholds: all of that config is built
    limits = spark.createDataFrame([LIMITS[0], ("ride", "median", -0.9, 0.9, -0.8, 0.8)], THRESHOLDS)
    written = refresh.refresh_deltas(spark, root, ["ride"], limits, seeds[1], as_of)
    assert ("ride", "2023-10") in written
    same(spark, root, (limits, seeds[1]), as_of)
    # a month that waits since a run broke off is built by the next
    refresh.mark_pending(spark, root, [("walk", "2023-10")])
    assert ("walk", "2023-10") in refresh.refresh_deltas(spark, root, ["walk"], limits, seeds[1], as_of)
    # much later, nothing of either is left, though only one of them runs
    assert refresh.refresh_deltas(spark, root, ["walk"], limits, seeds[1], datetime(2024, 5, 1)) == []
    assert not list((tmp_path / "t" / "deltas").rglob("*.parquet"))


def test_stored_side_of_a_merge_is_not_shuffled(spark, tmp_path):
    path, as_of = str(tmp_path / "versions"), datetime(2023, 10, 5)
    points = spark.createDataFrame([("walk", datetime(2023, 10, d), "car", float(d)) for d in range(1, 5)] + [("walk", None, "car", 1.0)],
                                   "config_name string, timestamp timestamp, dimension_split_value string, value double")
    touched, rejected = ingest.merge_points(spark, path, points, [config("walk")], ACTUALS, as_of)
    assert touched == [("walk", "2023-10")] and rejected == 1
    table = spark.table(versions_table(spark, path, ACTUALS))
    fresh = new_versions(describe_source(points.filter("timestamp is not null"), [config("walk")]), as_of).select("key", *POINT, "value")
    merged = merge_versions(table.filter(in_parts(touched)).select(*ACTUALS.names), fresh.repartition(BUCKETS, "key"), as_of,
                            describe=lambda rows: describe_source(rows, [config("walk")]))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    stored_side, incoming_side = plan.split("FileScan", 1)
    assert "Exchange" not in stored_side and incoming_side.count("Exchange") == 1, plan
    assert "Bucketed: true" in incoming_side and "(month#" in incoming_side  # the scan's own line: buckets and partition filters
    assert parts_of(merged) == touched and merged.count() == 4
