import hashlib
from datetime import date, datetime, timedelta, timezone

from tidewatch.operators import analysis as a
from tidewatch.schemas import INCIDENTS, PUBLICATIONS, REPLY_EVENTS

NOW = datetime(2024, 6, 1)


def publication(dataset, day, delay, environment="prod", interval="DAY", valid=date(2020, 1, 1), late=None):
    return (dataset, environment, day, datetime(day.year, day.month, day.day), interval, valid, delay, late)


def test_lag_flags(spark):
    recent = [date(2024, 5, 31) - timedelta(days=i) for i in range(40)]
    old = [d - timedelta(days=200) for d in recent]
    rows = [publication("ok", d, 30.0 + i) for i, d in enumerate(recent)]
    rows += [publication("few", d, 30.0) for d in recent[:29]]
    rows += [publication("quiet", d, 30.0) for d in old]
    rows += [publication("slow", d, 337.0) for d in recent]
    rows += [publication("stable", d, 169.0) for d in recent]
    rows += [publication("ok", recent[0], 1.0, interval="HOUR"), publication("ok", recent[0], None),
             publication("ok", date(2019, 1, 1), 1.0)]
    frame = spark.createDataFrame(rows, PUBLICATIONS)
    got = {r.dataset: r for r in a.publication_lags(frame, NOW).collect()}
    assert {k: r.flag for k, r in got.items()} == {
        "ok": "OK", "few": "INSUFFICIENT_DATA", "quiet": "NO_RECENT_DATA", "slow": "LIKELY_OBSOLETE",
        "stable": "LONG_STABLE_CYCLE"}
    ok = got["ok"]
    assert (ok.obs, ok.expected_delay_hour_suggested, ok.expected_delay_day_suggested, ok.max_h) == (40, 30.0, 2.0, 69.0)
    exact = {r.dataset: r for r in a.publication_lags(frame, NOW, exact=True).collect()}
    assert exact == got


def test_environments_side_by_side(spark):
    day = date(2024, 5, 1)
    rows = [publication("both", day, 10.0), publication("both", day, 12.0, "staging"), publication("one", day, 5.0)]
    got = {r.dataset: r.asDict() for r in a.environment_comparison(spark.createDataFrame(rows, PUBLICATIONS)).collect()}
    assert got["both"] == {"dataset": "both", "in_prod": True, "in_staging": True, "prod_min_h": 10.0,
                           "staging_min_h": 12.0, "prod_median_h": 10.0, "staging_median_h": 12.0}
    assert (got["one"]["in_staging"], got["one"]["staging_min_h"]) == (False, None)


def test_new_hashes(spark):
    stamp = datetime(2024, 5, 20, 3)
    deltas = spark.createDataFrame(
        [("c", "d'1", "mean", stamp, "critical_higher", "critical"), ("c", None, "mean", stamp, "normal", "normal"),
         ("c", None, "mean", stamp, "warning_lower", "warning"), ("c", "x", "mean", datetime(2024, 4, 1), "critical_lower", "critical")],
        "config_name string, dimension_split_value string, forecast_method string, timestamp timestamp, "
        "anomaly_type_lower_higher string, anomaly_type string")

    def digest(*values):
        return hashlib.sha256(str(list(values)).encode()).hexdigest()

    utc = stamp.replace(tzinfo=timezone.utc)
    first, second = (digest("c", "d'1", "mean", utc, "critical_higher"), digest("c", None, "mean", utc, "warning_lower"))
    index = spark.createDataFrame([(first, NOW - timedelta(days=10)), (second, NOW - timedelta(days=61))],
                                  "event_hash string, processed_at timestamp")
    rows = a.new_event_hashes(deltas, index, NOW).collect()
    assert [(r.event_hash, r.rendered_message) for r in rows] == [
        (second, "[backfill] c / None / mean / 2024-05-20T03:00:00+00:00 / warning_lower")]
    late = [publication("ds", date(2024, 5, 2), 1.0, late=1.5), publication("ds", date(2024, 5, 2), 1.0, late=9.0),
            publication("ds", date(2024, 5, 3), 1.0, late=1.0), publication("ds", date(2024, 5, 3), 1.0, "staging", late=5.0)]
    predicted = a.predicted_delay_anomalies(spark.createDataFrame(late, PUBLICATIONS), "delays").collect()
    assert [(r.config_name, r.dimension_split_value, r.timestamp) for r in predicted] == [
        ("delays", "ds", datetime(2024, 5, 2))]


def test_maintenance(spark):
    row = ("m", date(2024, 5, 1), "C", "t1", NOW, None, "open", "id", "{}")
    marker = ("m", date(2024, 4, 1), "", "BOOTSTRAP-m", NOW, NOW, "resolved", "id", "{}")
    other = ("n", date(2024, 5, 1), "C", None, NOW, None, "open", "id", "{}")
    frame = spark.createDataFrame([row, marker, other], INCIDENTS)
    closed = {r.slack_ts: (r.status, r.closed_at) for r in a.close_open_incidents(frame, "m", NOW).collect()}
    assert closed == {"t1": ("resolved", NOW), "BOOTSTRAP-m": ("resolved", NOW), None: ("open", None)}
    assert sorted(r.slack_ts or "" for r in a.without_bootstrap(frame, "m").collect()) == ["", "t1"]


def test_count_drift(spark):
    good = '{"critical_higher": 1, "critical_lower": 0, "warning_higher": 0, "warning_lower": 0}'
    rows = [("m", date(2024, 5, i), "C", f"t{i}", NOW, None, "open", "id", stored)
            for i, stored in ((1, good), (2, good), (3, "{broken"))]
    event = ("t1", "m", "d", "mean", "e", "C", "fire", "critical_higher", None, None, NOW, "e1")
    drift = a.count_drift(spark.createDataFrame(rows, INCIDENTS), spark.createDataFrame([event], REPLY_EVENTS)).collect()
    assert sorted((r.slack_ts, r.stored_critical_higher, r.logged_critical_higher) for r in drift) == [
        ("t2", 1, 0), ("t3", -1, 0)]


def test_percentiles_by_counts_and_sketches(spark):
    """Many equal delays, shares that fall between and on observations; sketches are off by a small part of the ranks."""
    import math

    delays = {"few": [float(v) for v in (5, 5, 7, 9)], "many": [float((k * 37) % 211) for k in range(2000)]}
    rows = [(name, "prod", date(2024, 1, 2), None, "DAY", date(2024, 1, 1), v, None) for name, all_ in delays.items() for v in all_]
    publications = spark.createDataFrame(rows, PUBLICATIONS)
    plan = a.publication_lags(publications, datetime(2024, 2, 1), exact=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower()
    for exact in (True, False):
        for r in a.publication_lags(publications, datetime(2024, 2, 1), exact).collect():
            ordered = sorted(delays[r.dataset])
            for name, share in (("p5_h", 0.05), ("p10_h", 0.1), ("p25_h", 0.25), ("median_h", 0.5)):
                place = math.ceil(share * len(ordered)) - 1
                slack = 0 if exact else 1 + len(ordered) // a.SKETCH
                assert ordered[max(place - slack, 0)] <= r[name] <= ordered[min(place + slack, len(ordered) - 1)]


def test_lags_from_daily_sketches(spark, tmp_path):
    """Days are sketched once, a later month is added or replaced alone, and percentiles are off by less than 1% of the ranks."""
    path, as_of = str(tmp_path / "daily"), datetime(2024, 4, 1)
    assert a.publication_lags_daily(spark, path, as_of).isEmpty()
    delays = {m: [float((k * 7919 * m) % 10007) for k in range(6000)] for m in (1, 2, 3)}

    def month(m, values):
        rows = [publication("many", date(2024, m, 1 + k % 28), v) for k, v in enumerate(values)]
        rows += [publication("few", date(2024, m, 5), 3.0 + m), publication("few", date(2024, m, 5), None)]
        return spark.createDataFrame(rows, PUBLICATIONS)

    for m, values in ((1, delays[1]), (2, [1.0]), (3, delays[3]), (2, delays[2])):
        a.refresh_daily_lags(month(m, values), path)
    got = {r.dataset: r for r in a.publication_lags_daily(spark, path, as_of).collect()}
    whole = month(1, delays[1]).union(month(2, delays[2])).union(month(3, delays[3]))
    for exact in a.publication_lags(whole, as_of, exact=True).collect():
        for name in ("scraper_started", "obs", "obs_last_90d", "expected_delay_hour_suggested", "max_h"):
            assert got[exact.dataset][name] == exact[name]
    ordered = sorted(v for values in delays.values() for v in values)
    for name, share in a.LAG_SHARES.items():
        places = [i for i, v in enumerate(ordered) if abs(v - got["many"][name]) <= 0.5]
        assert min(abs(i - share * len(ordered)) for i in places) < 0.01 * len(ordered)
    assert (got["few"].obs, got["few"].median_h, got["few"].flag) == (3, 5.0, "INSUFFICIENT_DATA")
