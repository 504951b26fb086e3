"""Scenarios of the incident state machine; each has its own config, all run together."""

import json
from collections import defaultdict
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.config import MetricConfig
from tidewatch.operators.threads import route_channels, silenced_threads
from tidewatch.operators.transitions import key_states, months_of_threads
from tidewatch.plans.alerting import alert_run, alert_tables, live_tables, write_run
from tidewatch.schemas import CHANNELS, INCIDENTS, REPLAY_ROWS, REPLY_EVENTS
from tidewatch.session import scratch, stored
from tidewatch.sources.tables import read_replay, write_partitioned

NOW = datetime(2031, 9, 17, 18, 45)
TODAY, MIDNIGHT = NOW.date(), datetime(2031, 9, 17)
LONG_AGO = date(2031, 8, 20)
HIGH, LOW, WARN, NORMAL = "critical_higher", "critical_lower", "warning_higher", "normal"


def counts(**values):
    return json.dumps({b: values.get(b, 0) for b in (HIGH, LOW, WARN, "warning_lower")})


class World:
    """Rows of many scenarios, collected and then run once."""

    def __init__(self):
        self.rows, self.incidents, self.events, self.modes = [], [], [], {}

    def row(self, config, kind=HIGH, dim="north", method="median", stamp=MIDNIGHT, forecast=40.0, actual=52.0, rel=0.3, day=None):
        self.rows.append((config, stamp, day, dim, method, kind, forecast, actual, rel, "about", None, None, ""))

    def incident(self, config, status="open", opened=timedelta(hours=1), closed=None, stored=None, day=TODAY, thread=None):
        self.incidents.append((config, day, "C-OPS", thread or f"t-{config}", NOW - opened,
                               NOW - closed if closed else None, status, "id", stored))

    def event(self, config, state=HIGH, kind="fire", dim="north", method="median", ago=45, log="x"):
        self.events.append((f"t-{config}", config, dim, method, "ev", "C-OPS", kind, state, None, None,
                            NOW - timedelta(minutes=ago), f"{log}{len(self.events):04d}"))

    def run(self, spark, replay=True, channels=(("", "dev", "C-OPS", "one", None),), **options):
        names = {r[0] for r in self.rows} | {i[0] for i in self.incidents}
        configs = [MetricConfig(name=n, source_sql="x", aggregation_mode=self.modes.get(n)) for n in names]
        rows = spark.createDataFrame(self.rows, REPLAY_ROWS)
        if not replay:
            rows = rows.selectExpr("*", "CASE WHEN anomaly_type_lower_higher = 'normal' THEN 'normal' ELSE 'critical' END "
                                        "AS anomaly_type")
        chans = [(c or None, *rest) for c, *rest in channels]
        return alert_run(rows, spark.createDataFrame(self.incidents, INCIDENTS),
                         spark.createDataFrame(self.events, REPLY_EVENTS), spark.createDataFrame(chans, CHANNELS),
                         configs, NOW, "dev", "rep", "page", replay=replay, **options)


def kinds_by_config(run):
    found = defaultdict(list)
    for r in sorted(run.actions.filter("visible").collect(),
                    key=lambda r: (r.config_name, r.phase, r.dimension_split_value, r.forecast_method)):
        found[r.config_name].append(r.kind)
    return found


@pytest.fixture(scope="module")
def scenarios(spark):
    w = World()
    w.row("first fire")
    w.row("same bucket"), w.incident("same bucket", stored=counts(critical_higher=1)), w.event("same bucket")
    w.row("severity", kind=WARN), w.incident("severity", stored=counts(critical_higher=1)), w.event("severity")
    w.row("resolve", kind=NORMAL), w.incident("resolve", stored=counts(critical_higher=1)), w.event("resolve")
    w.row("quiet", kind=NORMAL), w.incident("quiet", stored=counts())
    w.event("quiet", ago=60), w.event("quiet", kind="resolve", state=NORMAL, ago=45)
    for dim in ("north", "south", "west"):
        w.row("three dims", dim=dim)
    w.row("all normal", kind=NORMAL)
    w.row("hard cap"), w.incident("hard cap", opened=timedelta(days=8)), w.event("hard cap")
    w.row("value only", actual=99.0), w.incident("value only", stored=counts(critical_higher=1)), w.event("value only")
    w.row("latest wins", kind=HIGH, stamp=MIDNIGHT), w.row("latest wins", kind=NORMAL, stamp=MIDNIGHT + timedelta(hours=1))
    w.row("second dim"), w.row("second dim", dim="south", kind=WARN)
    w.incident("second dim", stored=counts(critical_higher=1)), w.event("second dim")
    w.row("debounced", kind=HIGH, dim="north"), w.row("debounced", kind=WARN, dim="south")
    w.incident("debounced", stored=counts(critical_higher=1, warning_higher=1))
    w.event("debounced", state=WARN, dim="north"), w.event("debounced", state=HIGH, dim="south")
    w.row("bad json"), w.incident("bad json", stored="{oops"), w.event("bad json", state=WARN)
    w.row("vanished", dim="south"), w.incident("vanished", stored=counts(critical_higher=1)), w.event("vanished", dim="north")
    w.row("refires"), w.incident("refires", stored=counts())
    w.event("refires", ago=60), w.event("refires", kind="resolve", state=NORMAL, ago=45)
    w.row("tie", kind=WARN), w.incident("tie", stored=counts(warning_higher=1))
    w.event("tie", state=WARN, ago=45, log="a"), w.event("tie", state=HIGH, ago=45, log="b")
    w.row("summary ignored"), w.incident("summary ignored", stored=counts(critical_higher=1))
    w.event("summary ignored", ago=45), w.event("summary ignored", kind="summary", state=None, ago=1)
    for mode, name in (("flat", "flat"), ("flat-with-resolve-replies", "hourly")):
        for label in ("open", "change", "over"):
            w.modes[f"{name} {label}"] = mode
        w.row(f"{name} open", dim="", kind=WARN)
        w.row(f"{name} change", dim="", kind=WARN), w.incident(f"{name} change"), w.event(f"{name} change", dim=None)
        w.row(f"{name} over", dim="", kind=NORMAL), w.incident(f"{name} over"), w.event(f"{name} over", dim=None)
    w.row("reopened"), w.incident("reopened", status="resolved", opened=timedelta(hours=9), closed=timedelta(hours=2))
    w.row("not reopened", kind=NORMAL)
    w.incident("not reopened", status="resolved", opened=timedelta(hours=9), closed=timedelta(hours=2))
    w.row("long ago"), w.incident("long ago", status="resolved", opened=timedelta(hours=50), closed=timedelta(hours=25))
    w.row("open first"), w.incident("open first", opened=timedelta(hours=9), stored=counts(critical_higher=1))
    w.incident("open first", status="resolved", opened=timedelta(hours=3), closed=timedelta(hours=2), thread="other")
    w.event("open first")
    return w.run(spark)


EXPECTED = {
    "first fire": ["open_thread", "fire"], "same bucket": [], "severity": ["severity_change", "summary"],
    "resolve": ["resolve", "summary", "close_thread"], "quiet": ["close_thread"],
    "three dims": ["open_thread", "fire", "fire", "fire"], "all normal": [], "hard cap": ["close_thread"],
    "value only": [], "latest wins": [], "second dim": ["fire", "summary"],
    "debounced": ["severity_change", "severity_change"], "bad json": ["severity_change", "summary"],
    "vanished": ["fire", "summary"], "refires": ["fire", "summary"], "tie": [], "summary ignored": [],
    "flat open": ["open_thread"], "flat change": [], "flat over": ["close_thread"],
    "hourly open": ["open_thread"], "hourly change": ["severity_change"], "hourly over": ["resolve", "close_thread"],
    "reopened": ["fire", "summary"], "not reopened": [], "long ago": ["open_thread", "fire"], "open first": [],
}


def test_actions(scenarios):
    got = kinds_by_config(scenarios)
    assert {name: got[name] for name in EXPECTED} == EXPECTED


def test_opener_carries_counts_or_first_row(scenarios):
    opened = {r.config_name: r for r in scenarios.actions.filter("kind = 'open_thread'").collect()}
    assert (opened["three dims"].critical_higher, opened["three dims"].has_counts) == (3, True)
    assert (opened["three dims"].severity, opened["three dims"].timestamp) == ("critical", None)
    flat = opened["flat open"]
    assert (flat.has_fire_card, flat.severity, flat.forecast_method, flat.delta_rel) == (True, "warning", "median", 0.3)


def test_summary_counts_are_projected(scenarios):
    summaries = {r.config_name: r for r in scenarios.actions.filter("kind = 'summary'").collect()}
    assert (summaries["second dim"].critical_higher, summaries["second dim"].warning_higher) == (1, 1)
    assert summaries["vanished"].critical_higher == 2  # a vanished dimension keeps firing
    assert summaries["resolve"].critical_higher == 0


def test_incidents_after(scenarios):
    after = {(r.config_name, r.slack_ts): r for r in scenarios.incidents.collect()}
    resolved = after[("resolve", "t-resolve")]
    assert (resolved.status, resolved.closed_at, resolved.summary_counts_json) == ("resolved", NOW, counts())
    assert after[("hard cap", "t-hard cap")].status == "resolved"
    reopened = after[("reopened", "t-reopened")]
    assert (reopened.status, reopened.closed_at) == ("open", None)
    assert after[("not reopened", "t-not reopened")].status == "resolved"
    fresh = [r for r in after.values() if r.config_name == "first fire"]
    assert [(r.status, r.summary_counts_json, r.opened_at) for r in fresh] == [("open", counts(critical_higher=1), NOW)]
    assert after[("open first", "other")].status == "resolved"


def test_hidden_transitions_are_logged_without_a_message(scenarios):
    events = {(r.config_name, r.kind): r for r in scenarios.events.collect()}
    assert events[("flat open", "fire")].slack_ts is None
    assert events[("first fire", "fire")].slack_ts is not None
    assert ("flat change", "summary") not in events
    assert events[("severity", "severity_change")].previous_anomaly_type_lower_higher == HIGH
    assert (events[("resolve", "resolve")].anomaly_type_lower_higher, events[("resolve", "resolve")].anomaly_timestamp) == (
        NORMAL, None)
    opened = {r.slack_ts for r in scenarios.incidents.collect()}
    assert {r.incident_slack_ts for r in events.values()} <= opened


def test_second_run_is_silent(spark):
    """What a run stores makes an immediate rerun of it emit nothing."""
    w = World()
    w.modes["flat"] = "flat"
    w.row("a"), w.row("a", dim="south", kind=WARN), w.row("flat", dim="")
    first = w.run(spark)
    w.incidents, w.events = [tuple(r) for r in first.incidents.collect()], [tuple(r) for r in first.events.collect()]
    again = w.run(spark)
    assert again.actions.isEmpty()
    assert sorted(map(tuple, again.incidents.collect())) == sorted(w.incidents)


def test_literal_mode_forgets_hidden_transitions(spark):
    w = World()
    w.modes["flat"] = "flat"
    w.row("flat", dim="")
    assert w.run(spark, parity=True).events.isEmpty()
    assert w.run(spark).events.count() == 1


def test_first_seen_configs_are_bootstrapped(spark):
    w = World()
    yesterday = MIDNIGHT - timedelta(days=1)
    w.row("new", stamp=yesterday), w.row("new", stamp=yesterday, dim="south", kind=LOW), w.row("new")
    w.row("known", stamp=yesterday)
    w.incident("known", status="resolved", opened=timedelta(days=20), closed=timedelta(days=19), day=LONG_AGO)
    run = w.run(spark, replay=False)
    got = {(r.config_name, r.anomaly_date, r.kind) for r in run.actions.collect()}
    assert got == {("new", TODAY, "open_thread"), ("new", TODAY, "fire"),
                   ("known", yesterday.date(), "open_thread"), ("known", yesterday.date(), "fire")}
    marker = [r for r in run.incidents.collect() if r.slack_ts.startswith("BOOTSTRAP-")]
    assert [(r.config_name, r.anomaly_date, r.status, r.summary_counts_json) for r in marker] == [
        ("new", yesterday.date(), "resolved", counts(critical_higher=1, critical_lower=1))]
    w.incidents = [tuple(r) for r in run.incidents.collect()]
    w.events = [tuple(r) for r in run.events.collect()]
    assert w.run(spark, replay=False).actions.isEmpty()


def test_suppressed_and_open_threads(spark):
    w = World()
    old = MIDNIGHT - timedelta(days=9)
    w.row("silenced", stamp=old)
    w.incident("silenced", status="resolved", opened=timedelta(days=8), closed=timedelta(hours=1), day=old.date())
    w.incident("silenced too", status="open", opened=timedelta(days=9), day=old.date())
    w.incident("silenced too", status="resolved", opened=timedelta(days=8), closed=timedelta(hours=1), day=old.date(),
               thread="later")
    w.incident("no rows", day=old.date(), opened=timedelta(days=2)), w.event("no rows", kind="resolve", state=NORMAL)
    w.incident("still firing", day=old.date(), opened=timedelta(days=2)), w.event("still firing")
    w.row("watched", kind=NORMAL), w.row("watched", kind=HIGH, stamp=MIDNIGHT - timedelta(hours=-1)),
    w.row("watched", kind=NORMAL, stamp=MIDNIGHT + timedelta(hours=2))
    w.incident("watched", stored=counts(critical_higher=1)), w.event("watched")
    run = w.run(spark, replay=False)
    assert kinds_by_config(run) == {"no rows": ["close_thread"], "watched": ["resolve", "summary", "close_thread"]}
    frame = spark.createDataFrame(w.incidents, INCIDENTS)
    assert sorted(r.config_name for r in silenced_threads(frame, NOW).collect()) == ["silenced", "silenced too"]


def test_rows_without_method_or_recent_date_never_alert(spark):
    w = World()
    w.incident("m", status="resolved", opened=timedelta(days=20), closed=timedelta(days=19), day=LONG_AGO)
    w.row("m", method=None), w.row("m", stamp=MIDNIGHT - timedelta(days=31))
    assert w.run(spark, replay=False).actions.isEmpty()


def test_unmapped_threads_are_skipped(spark):
    w = World()
    w.row("mapped"), w.row("unmapped")
    run = w.run(spark, channels=[("mapped", "dev", "C9", "x", None), ("", "prod", "C-OPS", "y", None)])
    assert {r.slack_channel_id for r in run.actions.collect()} == {"C9"}
    assert [r.config_name for r in run.rejected.collect()] == ["unmapped"]


def test_routing_prefers_the_exact_row(spark):
    channels = spark.createDataFrame(
        [("a", "dev", "C-A", "a", None), (None, "dev", "C-DEV", "d", None), ("b", "prod", "C-B", "b", None)], CHANNELS)
    threads = spark.createDataFrame([("a",), ("b",)], "config_name string")

    def routed(environment):
        return {r[0]: r.slack_channel_id for r in route_channels(threads, channels, environment).collect()}

    assert routed("dev") == {"a": "C-A", "b": "C-DEV"}
    assert routed("prod") == {"a": None, "b": "C-B"}


def test_replay_file(spark, tmp_path):
    rows = [{"config_name": "c", "timestamp": "2031-09-11T00:00:00Z", "dimension_split_value": None,
             "forecast_method": "median", "anomaly_type_lower_higher": HIGH, "forecast_value": 40.0, "actual_value": 52.0,
             "delta_rel": 0.3, "description": "from a file"}, {"config_name": "undated", "anomaly_type_lower_higher": HIGH}]
    path = tmp_path / "rows.json"
    path.write_text(json.dumps(rows))
    frame = read_replay(spark, str(path))
    empty = spark.createDataFrame([], INCIDENTS), spark.createDataFrame([], REPLY_EVENTS)
    run = alert_run(frame, *empty, spark.createDataFrame([(None, "dev", "C", "n", None)], CHANNELS), [], NOW, "dev",
                    replay=True)
    assert sorted((r.kind, r.anomaly_date) for r in run.actions.collect()) == [
        ("fire", date(2031, 9, 11)), ("open_thread", date(2031, 9, 11))]
    assert [r.config_name for r in run.undated.collect()] == ["undated"]


def test_written_runs(spark, tmp_path):
    w, root = World(), str(tmp_path / "alerts")
    for dim in ("south", "north", "west"):
        w.row("new", dim=dim)
    w.row("over", kind=NORMAL), w.incident("over", opened=timedelta(days=40), stored=counts(critical_higher=1))
    w.event("over"), w.incident("other", status="resolved", opened=timedelta(days=80), closed=timedelta(days=79))
    write_partitioned(spark.createDataFrame(w.incidents, INCIDENTS), f"{root}/incidents", "opened_at")
    write_partitioned(spark.createDataFrame(w.events, REPLY_EVENTS), f"{root}/events", "posted_at")
    rows = spark.createDataFrame(w.rows, REPLAY_ROWS)
    channels = spark.createDataFrame([(None, "dev", "C-OPS", "one", None)], CHANNELS)

    def content(name):
        return sorted(map(str, spark.read.parquet(f"{root}/{name}").collect()))

    def write(broken_off=False):
        run = alert_run(rows, *alert_tables(spark, root), channels, [], NOW, "dev", "rep", "page", replay=True)
        if broken_off:  # after outbox and events, before the incidents
            run.before = run.before.filter("raise_error('stop') IS NOT NULL")
            with pytest.raises(Exception, match="stop"):
                write_run(run, root)
        else:
            write_run(run, root)

    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / f"alerts/incidents/month={NOW - timedelta(days=80):%Y-%m}").iterdir()}
    write(broken_off=True)
    write()
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / f"alerts/incidents/month={NOW - timedelta(days=80):%Y-%m}").iterdir()}
    first = {name: content(name) for name in ("incidents", "events", "outbox")}
    assert len(first["incidents"]) == 3
    messages = spark.read.parquet(f"{root}/outbox").orderBy("action_seq").collect()
    assert [r.action_seq for r in messages] == list(range(1, len(messages) + 1))
    assert [r.kind for r in messages if r.config_name == "new"][0] == "open_thread"
    assert [r.dimension_split_value for r in messages if r.kind == "fire"] == ["north", "south", "west"]
    write()
    assert {name: content(name) for name in first} == first


def test_closed_months_are_not_read(spark, tmp_path):
    """A run on pruned tables decides what one on whole tables decides, and rests on few months."""
    w, root = World(), str(tmp_path / "alerts")
    old = MIDNIGHT - timedelta(days=200)
    w.row("known", stamp=MIDNIGHT), w.row("new", stamp=MIDNIGHT - timedelta(days=1))
    w.row("watched", kind=HIGH), w.row("watched", kind=NORMAL, stamp=MIDNIGHT + timedelta(hours=2))
    w.incident("watched", stored=counts(critical_higher=1)), w.event("watched")
    for name in ("known", "fires later"):
        w.incident(name, status="resolved", opened=timedelta(days=400), closed=timedelta(days=399), day=date(2030, 8, 13))
    w.incident("left open", opened=timedelta(days=200), day=old.date())  # has to be closed
    w.incident("silenced", opened=timedelta(days=300), day=old.date())
    w.incident("silenced", status="resolved", opened=timedelta(days=250), closed=timedelta(days=249), day=old.date(), thread="later")
    w.event("known", ago=60 * 24 * 390), w.event("left open", ago=60 * 24 * 199)
    write_partitioned(spark.createDataFrame(w.incidents, INCIDENTS), f"{root}/incidents", "opened_at")
    write_partitioned(spark.createDataFrame(w.events, REPLY_EVENTS), f"{root}/events", "posted_at")
    w.row("fires later", stamp=MIDNIGHT - timedelta(days=1))
    later = spark.createDataFrame(w.rows, REPLAY_ROWS).withColumn(
        "anomaly_type", F.when(F.col("anomaly_type_lower_higher") == NORMAL, NORMAL).otherwise("critical"))
    rows = later.filter("config_name != 'fires later'")
    channels = spark.createDataFrame([(None, "dev", "C-OPS", "one", None)], CHANNELS)

    def decide(incidents, events, known=None, at=NOW, rows=later):
        run = alert_run(rows, incidents, events, channels, [], at, "dev", "rep", "page", known=known)
        return run, sorted((r.config_name, r.kind) for r in run.actions.collect())

    def months(frame):
        return {row[0].split("month=")[1][:7] for row in frame.select(F.input_file_name()).distinct().collect()}

    first, decided = decide(*live_tables(spark, root, NOW), rows=rows)  # nothing is noted yet: all months are read
    assert decided == [("known", "fire"), ("known", "open_thread"), ("left open", "close_thread"), ("watched", "close_thread"),
                       ("watched", "resolve"), ("watched", "summary")]
    write_run(first, root)
    for at in (NOW, NOW + timedelta(days=1)):  # the second one finds what the first one noted after closing
        incidents, events, known = live_tables(spark, root, at)
        assert months(incidents) <= {f"{NOW - timedelta(days=back):%Y-%m}" for back in (0, 30, 200)}
        run, got = decide(incidents, events, known, at)
        assert got == decide(*alert_tables(spark, root), at=at)[1]
        assert (("fires later", "open_thread") in got) == (at == NOW)  # a known config, though its incident is not read
        write_run(run, root)
    assert months(live_tables(spark, root, NOW)[0]) == {"2031-09"}
    assert len(list((tmp_path / "alerts" / "live").iterdir())) == 1

    state = spark.createDataFrame([("watched", TODAY, False, "t-watched", NOW - timedelta(hours=1))],
                                  "config_name string, anomaly_date date, hard_cap boolean, incident_slack_ts string, opened_at timestamp")
    dated_rows = rows.withColumn("anomaly_date", F.to_date("timestamp"))
    plan = key_states(state, dated_rows, live_tables(spark, root, NOW)[1], NOW)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters: [", 1)[1] and "month" in plan


def test_months_of_threads(spark):
    schema = "incident_slack_ts string, opened_at timestamp"
    state = spark.createDataFrame([("a", datetime(2031, 8, 31, 23)), (None, datetime(2031, 1, 1)), ("b", NOW)], schema)
    assert sorted(r[0] for r in months_of_threads(state, NOW).collect()) == ["2031-08", "2031-09"]
    unknown = spark.createDataFrame([("a", None)], schema)
    got = sorted(r[0] for r in months_of_threads(unknown, NOW).collect())
    assert (got[0], got[-1], len(got)) == ("2012-01", "2031-09", 237)
    assert months_of_threads(state.limit(0), NOW).isEmpty()


def test_scratch_folders_are_removed(spark):
    with scratch(spark, "trial") as folder:
        assert stored(spark.range(3), "kept").count() == 3 and Path(folder).exists()
    assert not Path(folder).exists()
