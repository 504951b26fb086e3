import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewatch.config import MetricConfig
from tidewatch.operators import deltas as d
from tidewatch.operators.actuals import describe_source
from tidewatch.operators.versions import OPEN_END, new_versions
from tidewatch.schemas import DESCRIPTIONS, THRESHOLDS

POINT = "config_name string, timestamp timestamp, dimension_split_value string, value double"
FORECAST = "config_name string, timestamp timestamp, dimension_split_value string, forecast_method string, value double"
DAY = datetime(2024, 1, 1)
NOW = datetime(2024, 1, 20)
CFG = MetricConfig(name="m", source_dataset="ds", source_table="t", source_forecast_column="c",
                   source_forecast_column_sql="SUM(x)", source_sql="q")


def build(spark, actual, predicted, limits, texts=(), fine_grained=True, now=NOW, cfg=CFG):
    acts = new_versions(describe_source(spark.createDataFrame(actual, POINT), [cfg]), now)
    preds = new_versions(describe_source(spark.createDataFrame(predicted, FORECAST), [cfg]), now)
    return d.build_deltas(acts, preds, spark.createDataFrame(limits, THRESHOLDS),
                          spark.createDataFrame(list(texts), DESCRIPTIONS), now, fine_grained)


def test_classes_on_edge_rows(spark):
    cases = {  # dimension: (actual, forecast, class)
        "on critical": (15.0, 10.0, "warning_higher"), "on warning": (13.0, 10.0, "normal"), "above": (15.1, 10.0, "critical_higher"),
        "warn": (13.1, 10.0, "warning_higher"), "below": (4.9, 10.0, "critical_lower"),
        "warn low": (6.9, 10.0, "warning_lower"), "zero forecast": (5.0, 0.0, "normal"),
        "negative forecast": (5.0, -10.0, "critical_lower"), "missing actual": (None, 10.0, "critical_lower"),
        "missing forecast": (5.0, None, "normal"),
    }
    actual = [("m", DAY, k, a) for k, (a, _, _) in cases.items() if a is not None]
    predicted = [("m", DAY, k, "mean", f) for k, (_, f, _) in cases.items() if f is not None]
    got = {r.dimension_split_value: r for r in build(
        spark, actual, predicted, [("m", "mean", -0.5, 0.5, -0.3, 0.3)], [("m", "text", None, None)]).collect()}
    assert {k: r.anomaly_type_lower_higher for k, r in got.items()} == {k: c for k, (_, _, c) in cases.items()}
    assert got["zero forecast"].delta_rel is None and got["zero forecast"].delta == 5.0
    assert got["negative forecast"].delta_rel == -1.5 and got["negative forecast"].delta_rel_winsorised == -1.0
    assert got["missing actual"].actual_value == 0.0 and got["missing actual"].actual_timestamp is None
    assert got["missing forecast"].forecast_method is None
    row = got["above"]
    assert (row.source_dataset_table, row.source_dataset_table_column, row.source_sql) == ("ds.t", "ds.t.c", "q")
    assert (row.critical_higher_value, row.warning_lower_delta_threshold) == (15.0, -3.0)
    assert (row.exceeded_threshold_lower_higher, row.anomaly_type, row.description) == (0.5, "critical", "text")


def test_missing_thresholds_never_fire_and_order_decides(spark):
    actual = [("m", DAY, "a", 100.0), ("m", DAY, "b", 1.0)]
    predicted = [("m", DAY, dim, method, 10.0) for dim in "ab" for method in ("mean", "max", "none")]
    limits = [("m", "mean", None, 1.0, None, None), ("m", "max", 99.0, 0.5, None, None)]
    got = {(r.dimension_split_value, r.forecast_method): r.anomaly_type_lower_higher
           for r in build(spark, actual, predicted, limits).collect()}
    assert got == {("a", "mean"): "critical_higher", ("a", "max"): "critical_lower", ("a", "none"): "normal",
                   ("b", "mean"): "normal", ("b", "max"): "critical_lower", ("b", "none"): "normal"}


def test_null_dimension_never_matches(spark):
    rows = build(spark, [("m", DAY, None, 1.0)], [("m", DAY, None, "mean", 1.0)], []).collect()
    assert len(rows) == 2


def test_stale_configs_and_future_forecasts(spark):
    now = datetime(2024, 3, 1, 12)
    actual = [("m", datetime(2024, 1, 1), "", 1.0), ("gone", datetime(2023, 12, 31), "", 1.0)]
    predicted = [(c, t, "", "mean", 1.0) for c in ("m", "gone") for t in (datetime(2024, 1, 1), datetime(2024, 1, 2))]
    rows = build(spark, actual, predicted, [], now=now).collect()
    assert [(r.config_name, r.timestamp) for r in rows] == [("m", datetime(2024, 1, 1))]


def test_superseded_versions_are_ignored(spark):
    acts = new_versions(describe_source(spark.createDataFrame([("m", DAY, "", 1.0)], POINT), [CFG]), NOW)
    preds = new_versions(describe_source(spark.createDataFrame([("m", DAY, "", "mean", 1.0)], FORECAST), [CFG]), NOW)
    closed = preds.withColumns({"value": F.lit(9.0), "is_latest": F.lit(False), "valid_to": F.lit(NOW)})
    old = acts.withColumns({"value": F.lit(9.0), "is_latest": F.lit(False)})
    empty = spark.createDataFrame([], THRESHOLDS), spark.createDataFrame([], DESCRIPTIONS)
    rows = d.build_deltas(acts.union(old), preds.union(closed), *empty, NOW).collect()
    assert [(r.actual_value, r.forecast_value) for r in rows] == [(1.0, 1.0)]
    assert preds.first().valid_to == OPEN_END


def test_starts_and_ends(spark):
    kinds = [5.0, 20.0, 20.0, 13.5, 10.0, 10.0, 1.0, 10.0]  # first is low: no start without a predecessor
    actual = [("m", DAY + timedelta(days=i), "", v) for i, v in enumerate(kinds)]
    predicted = [("m", DAY + timedelta(days=i), "", "mean", 10.0) for i in range(len(kinds))]
    rows = sorted(build(spark, actual, predicted, [("m", "mean", -0.4, 0.5, -0.3, 0.3)]).collect(),
                  key=lambda r: r.timestamp)
    starts = {i: r.anomaly_type_lower_higher_start for i, r in enumerate(rows) if r.anomaly_type_lower_higher_start}
    ends = {i: r.anomaly_type_lower_higher_end for i, r in enumerate(rows) if r.anomaly_type_lower_higher_end}
    assert starts == {6: "critical_lower"} and ends == {4: "warning_higher", 7: "critical_lower"}
    assert [r.actual_value_debounced for r in rows] == [None] * 6 + [1.0, None]
    assert rows[6].anomaly_value_windsorised_debounced == -0.9


def test_order_across_stretches_matches_one_window(spark):
    """A series of minutes over months is ordered in stretches with gaps between them."""
    random.seed(3)
    stamps = sorted({DAY + timedelta(days=random.choice([0, 1, 40, 41, 170, 400]), minutes=random.randrange(1440))
                     for _ in range(400)})
    kinds = ["normal", "warning_lower", "critical_higher"]
    rows = [("m", "mean", dim, t, random.choice(kinds), period) for dim, period in (("a", "minute"), ("b", "hour"), (None, "second"))
            for t in stamps]
    frame = spark.createDataFrame(rows, "config_name string, forecast_method string, dimension_split_value string, "
                                        "timestamp timestamp, anomaly_type_lower_higher string, period_length string")
    split, whole = (d.previous_class(frame, fine).select(*frame.columns, "_previous") for fine in (True, False))
    assert split.count() == len(rows)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()
