from datetime import datetime

from pyspark.sql import functions as F, types as T

from tidewatch.config import MetricConfig
from tidewatch.operators.transitions import announced_states
from tidewatch.schemas import REPLY_EVENTS
from tidewatch.streaming import jobs

SCHEMA = "ts timestamp, kind string, value double"
CFG = MetricConfig(name="m", source_timestamp_column_sql="ts", source_forecast_column_sql="SUM(value)",
                   dimension_split="kind")


def feed(spark, folder, *batches):
    """One file per batch; ``maxFilesPerTrigger`` makes them micro-batches."""
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def collect(spark, stream, name, mode):
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return [tuple(r) for r in spark.table(name).collect()]


def day(number, hour=0):
    return datetime(2024, 1, number, hour)


def test_late_rows_update_until_the_watermark(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [(day(1), "a", 1.0), (day(3), "a", 1.0)], [(day(2), "a", 5.0)],
                  [(day(20), "a", 1.0)], [(day(20), "a", 1.0)], [(day(1, 5), "a", 100.0), (day(19), "b", 2.0)])
    rows = collect(spark, jobs.metric_points_stream(stream, CFG, "3 days").filter("timestamp < '2024-01-19'"),
                   "late_points", "update")
    assert max(r[3] for r in rows if r[1] == day(1)) == 1.0  # too late to count
    assert max(r[3] for r in rows if r[1] == day(2)) == 5.0


def test_final_points_appear_once(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [(day(1), "a", 1.0)], [(day(1, 9), "a", 2.0)], [(day(9), "a", 4.0)])
    rows = collect(spark, jobs.metric_points_stream(stream, CFG, "3 days"), "final_points", "append")
    assert rows == [("m", day(1), "a", 3.0)]


def test_announced_state_matches_batch(spark, tmp_path):
    log = [("t1", "m", dim, "mean", "e", "C", kind, state, None, None, day(1, hour), f"id{i}")
           for i, (dim, kind, state, hour) in enumerate([
               ("a", "fire", "warning_lower", 1), ("a", "severity_change", "critical_lower", 3), ("b", "fire", "critical_higher", 2),
               ("b", "resolve", "normal", 4), (None, "fire", "warning_higher", 1), (None, "summary", None, 5),
               ("c", "fire", "warning_lower", 2), ("c", "severity_change", "critical_lower", 2)])]
    events = spark.createDataFrame(log, REPLY_EVENTS)
    months = events.withColumn("month", F.when(F.col("client_msg_id") < "id4", "2024-01").otherwise("2024-02"))
    months.repartition(3).write.partitionBy("month").parquet(str(tmp_path / "log"))
    batch = {tuple(r) for r in announced_states(events).select(
        "incident_slack_ts", "dimension_split_value", "forecast_method", "announced", "posted_at").collect()}
    assert {tuple(r) for r in jobs.run_announced_state(spark, str(tmp_path / "log")).collect()} == batch


def test_keys_are_forgotten_past_the_cap(spark, tmp_path):
    """Timers follow the newest event of a key; a stream that goes on finds the state it left."""
    log, place = str(tmp_path / "log"), str(tmp_path / "place")

    def post(*events):
        rows = [("t1", "m", dim, "mean", "e", "C", "fire", state, None, None, stamp, name) for dim, state, stamp, name in events]
        spark.createDataFrame(rows, REPLY_EVENTS).coalesce(1).write.mode("append").parquet(log)
        result = jobs.run_announced_state(spark, log, place, files_per_batch=1)
        held = spark.read.format("statestore").option("path", f"{place}/progress").option("stateVarName", "held").load()
        return ({r.dimension_split_value: (r.announced, r.posted_at) for r in result.collect()},
                {r.key.dimension_split_value for r in held.collect()})

    first, held = post(("a", "x1", day(1), "1"), ("b", "x1", day(1), "2"), (None, "x1", day(1), "3"), ("c", "x1", None, "4"))
    assert first == {dim: ("x1", day(1)) for dim in ("a", "b", "")} and held == {"a", "b", ""}
    second, held = post(("a", "x2", day(9), "5"), ("b", "x0", day(1), "0"))
    assert second == {"a": ("x2", day(9)), "b": ("x0", day(1)), "": ("x1", day(1))}
    third, held = post(("d", "x3", day(20), "6"))  # the watermark passes the caps of all but the newest events
    assert third == {**second, "d": ("x3", day(20))} and held == {"a", "d"}


def test_repeated_hashes_are_dropped(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [(day(1), "a", 1.0), (day(1), "a", 1.0)], [(day(1, 0), "a", 1.0), (day(2), "b", 1.0)])
    hashes = jobs.distinct_hashes_stream(stream.withColumn("event_type", F.col("kind")))
    assert len(collect(spark, hashes, "hashes", "append")) == 2


def test_versions_follow_micro_batches(spark, tmp_path):
    for rows in ([(day(1), "a", 1.0)], [(day(1, 5), "a", 2.0), (day(2), "a", 1.0)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = jobs.run_versions(spark, str(tmp_path / "in"), "*.parquet", CFG, day(3), files_per_batch=1)
    current = {(r.timestamp, r.value) for r in table.filter("is_latest").collect()}
    assert current == {(day(1), 3.0), (day(2), 1.0)}
    assert table.filter("NOT is_latest").count() <= 1


def add(spark, folder, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def test_a_garbage_stamp_does_not_silence_a_stream(spark, tmp_path):
    for rows in ([(day(1), "a", 1.0)], [(datetime(2150, 1, 1), "a", 9.0)], [(day(2), "a", 5.0)]):
        add(spark, tmp_path / "in", *rows)
    table = jobs.run_versions(spark, str(tmp_path / "in"), "*.parquet", CFG, day(3), "1 day", files_per_batch=1)
    assert {(r.timestamp, r.value) for r in table.collect()} == {(day(1), 1.0), (day(2), 5.0)}


def test_batches_are_folded(spark, tmp_path):
    """The newest row of a key stands, folders stay few, and a batch that comes again changes nothing."""
    schema, path = T._parse_datatype_string("k int, v int"), str(tmp_path / "table")
    changes, expected = jobs.Changes(spark, path, schema, ["k"], ["v"]), {}
    assert changes.newest().isEmpty()
    for number in range(50):
        rows = [(number % 7, number), (100 + number, number)]
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        changes.add(frame, number)
        expected |= dict(rows)
        if number in (3, 7, 49):
            changes.add(frame, number)  # after a failure
        if number == 20:  # a fold that broke off before its commit does not count
            (tmp_path / "table" / "first=0" / "batch=63").mkdir(parents=True)
    assert dict(map(tuple, changes.newest().collect())) == expected
    assert changes.folders() == [*[(k, k + 7) for k in range(0, 48, 8)], (48, 48), (49, 49)]
    assert len(list((tmp_path / "table").glob("*/*"))) == 8


def test_streams_go_on_where_they_ended(spark, tmp_path):
    source = str(tmp_path / "in")

    def results():
        points = jobs.run_metric_points(spark, source, "*.parquet", CFG, location=str(tmp_path / "points"))
        final = jobs.run_final_points(spark, source, "*.parquet", CFG, "1 day", location=str(tmp_path / "final"))
        versions = jobs.run_versions(spark, source, "*.parquet", CFG, lambda number: day(20, number),
                                     location=str(tmp_path / "versions"))
        return ({(r.timestamp, r.value) for r in points.collect()}, sorted((r.timestamp, r.value) for r in final.collect()),
                {(r.timestamp, r.value, r.valid_from, r.is_latest) for r in versions.collect()})

    add(spark, source, (day(1), "a", 1.0), (day(2), "a", 1.0))
    first = results()
    assert first[0] == {(day(1), 1.0), (day(2), 1.0)}
    add(spark, source, (day(2, 5), "a", 2.0), (day(9), "a", 4.0))
    points, final, versions = results()
    assert points == {(day(1), 1.0), (day(2), 3.0), (day(9), 4.0)}
    assert final == [(day(1), 1.0), (day(2), 3.0)]  # each once
    kept, closed = (day(1), 1.0), [v for v in versions if not v[3]]
    assert [v[:2] for v in closed] == [(day(2), 1.0)]
    assert {v[:2] for v in versions if v[3]} == {kept, (day(2), 3.0), (day(9), 4.0)}
    begun = next(v[2] for v in versions if v[:2] == kept)
    assert next(v[2] for v in versions if v[:2] == (day(2), 3.0)) > begun  # each batch has its time
    assert results() == (points, final, versions)  # nothing new arrived
