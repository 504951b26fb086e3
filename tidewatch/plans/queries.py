"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.config import MetricConfig, config_file, load_configs
from tidewatch.operators import analysis, threads as th, transitions as tr
from tidewatch.operators.actuals import aggregate_points, build_points, current_values, describe_source
from tidewatch.operators.deltas import add_definitions, build_deltas, due_forecasts, known_definitions, live_actuals, match_points, newest_actuals
from tidewatch.operators.forecast import forecast
from tidewatch.operators.grid import forecast_grid, history_grid, missing_periods, retained_periods
from tidewatch.operators.messages import dashboard_link
from tidewatch.operators.versions import merge_versions, new_versions, tombstone
from tidewatch.plans import workload as w
from tidewatch.plans.alerting import alert_run, alert_tables, live_tables, relevant_rows, thread_states, write_run
from tidewatch.plans.ingest import fetch_actuals, ingest_run
from tidewatch.schemas import ACTUALS, DEDUP_INDEX, FORECASTS, OUTBOX
from tidewatch.session import ensure_checkpoint_dir, ensure_utc, stored
from tidewatch.sources.tables import read_descriptions, read_partitioned, read_replay, read_thresholds, write_partitioned
from tidewatch.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

POINT = ["config_name", "dimension_split_value", "timestamp"]
STREAM_CUT = datetime(2024, 1, 15, 12)
FIRST_LOAD, SECOND_LOAD = datetime(2024, 1, 20, 14), w.NOW


def query(function: Query) -> Query:
    """Register; dates leave as text so that every client shows them alike."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = function(ensure_utc(spark), folder)
        dates = {f.name: F.col(f.name).cast("string") for f in result.schema.fields if isinstance(f.dataType, T.DateType)}
        return result.withColumns(dates) if dates else result
    run.__doc__ = function.__doc__
    REGISTRY[function.__name__] = run
    return function


def _reader(spark: SparkSession, folder: str) -> Callable[[MetricConfig], DataFrame]:
    return lambda cfg: w.table(spark, folder, cfg.source_table)


def _points(spark: SparkSession, folder: str, *configs: MetricConfig, **options) -> DataFrame:
    return build_points(spark, list(configs), _reader(spark, folder), w.NOW, sane=w.SANE, **options)


def _events(name: str, value: str, **more) -> MetricConfig:
    return w._metric(name, "events", "ts", value, {}, **{"history_start": w.FIRST_DAY, **more})


def _named(name: str, **changes) -> MetricConfig:
    return replace(next(cfg for cfg in w.event_configs() if cfg.name == name), **changes)


def _rounded(frame: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns or ("value",)})


# --- metric points ---------------------------------------------------------------


@query
def actuals_daily_by_dim(spark, folder):
    """Rows per day and event type."""
    return _points(spark, folder, _named(w.BY_TYPE))


@query
def actuals_hourly_total(spark, folder):
    """Sum per hour without a dimension."""
    return _rounded(_points(spark, folder, _named(w.HOURLY)), 2)


@query
def actuals_min(spark, folder):
    return _points(spark, folder, _events("events_min_value_daily", "MIN(value)", dimension_split="event_type"))


@query
def actuals_ratio(spark, folder):
    return _rounded(_points(spark, folder, _named(w.RATIO)))


@query
def actuals_filtered(spark, folder):
    """User filter on top of the history bound."""
    cfg = _events("events_filtered_daily", "SUM(value)", dimension_split="event_type", history_start="2024-01-05",
                  source_filter_sql="event_type NOT IN ('view', 'click') AND value > 10 AND user_id != 7")
    return _rounded(_points(spark, folder, cfg), 2)


@query
def actuals_shared_scan(spark, folder):
    """Four metrics of one source in one pass."""
    values = {"n": "COUNT(*)", "total": "SUM(value)", "least": "MIN(value)", "most": "MAX(value)"}
    configs = [_events(f"events_{name}", sql, dimension_split="event_type") for name, sql in values.items()]
    return _rounded(aggregate_points(w.table(spark, folder, "events"), configs, w.NOW), 2)


@query
def actuals_custom_sql(spark, folder):
    """A metric that brings its own query, with placeholders."""
    w.table(spark, folder, "orders").createOrReplaceTempView("tidewatch_orders")
    cfg = MetricConfig(
        name="orders_price_by_status", source_table="tidewatch_orders", source_timestamp_column_sql="o_orderdate",
        history_start="1996-01-01", source_sql="""
            SELECT SUM(o_totalprice) AS value, DATE_TRUNC('MONTH', o_orderdate) AS timestamp,
                   o_orderstatus AS dimension_split_value
            FROM {source_table}
            WHERE {source_timestamp_column_sql} >= '{history_start}'
              AND {source_timestamp_column_sql} IN ({missing_timestamps_sql})
              AND {source_timestamp_column_sql} NOT IN ({existing_timestamps_sql})
            GROUP BY ALL""")
    return _rounded(build_points(spark, [cfg], _reader(spark, folder), w.NOW), 2)


@query
def actuals_custom_sql_delta(spark, folder):
    """A delta load of a metric with its own query: only the months without a stored value, through the placeholder."""
    view = "tidewatch_orders"
    w.table(spark, folder, "orders").createOrReplaceTempView(view)
    cfg = MetricConfig(
        name="orders_price_monthly", source_table=view, source_timestamp_column_sql="o_orderdate", history_start="1996-01-01",
        period_length="month", source_sql="""
            WITH months AS (SELECT *, DATE_TRUNC('MONTH', {source_timestamp_column_sql}) AS month FROM {source_table})
            SELECT SUM(o_totalprice) AS value, month AS timestamp, o_orderstatus AS dimension_split_value FROM months
            WHERE month IN ({missing_timestamps_sql}) AND month NOT IN ({existing_timestamps_sql})
            GROUP BY ALL""")
    dear = replace(cfg, source_sql="", source_filter_sql="o_totalprice > 300000 AND MONTH(o_orderdate) <> 7",
                   source_forecast_column_sql="COUNT(*)")
    held = aggregate_points(w.table(spark, folder, "orders"), [dear], w.ORDERS_NOW, sane=w.SANE)
    versions = new_versions(describe_source(held, [cfg]), w.ORDERS_NOW)
    return _rounded(fetch_actuals(spark, [cfg], _reader(spark, folder), versions, w.ORDERS_NOW), 2)


@query
def actuals_from_yaml(spark, folder):
    """Metrics defined in a YAML file."""
    configs = list(load_configs(config_file(Path(__file__).parent, "dev")).values())
    return _points(spark, folder, *configs)


@query
def actuals_drop_unfinal(spark, folder):
    """Without the newest three hours."""
    return _rounded(_points(spark, folder, _named(w.HOURLY, skip_newest_rows=3)), 2)


@query
def actuals_calendar_periods(spark, folder):
    """Orders per week (from Sunday), month, quarter and year."""
    configs = [replace(w.orders_config(f"orders_per_{p}", "COUNT(*)", {}), period_length=p)
               for p in ("week", "month", "quarter", "year")]
    return _points(spark, folder, *configs)


@query
def actuals_delta_load(spark, folder):
    """Only periods without a stored value, found through the stored versions."""
    cfg = _named(w.BY_TYPE)
    held = _points(spark, folder, replace(cfg, source_filter_sql="value > 250"))
    table = new_versions(describe_source(held, [cfg]), w.NOW)
    return fetch_actuals(spark, [cfg], _reader(spark, folder), table, w.NOW, sane=w.SANE)


# --- grids -----------------------------------------------------------------------


def _held_hours(spark, folder) -> DataFrame:
    return _points(spark, folder, _named(w.HOURLY, source_filter_sql="value > 120"))


@query
def missing_periods_hourly(spark, folder):
    """Hours of the history without a stored value."""
    cfg = _named(w.HOURLY)
    return missing_periods(history_grid(spark, [cfg], w.NOW), _held_hours(spark, folder), [cfg], w.NOW)


@query
def refetch_window(spark, folder):
    """As above, and the last five days again."""
    cfg = _named(w.HOURLY, refetch_recent_days=5)
    return missing_periods(history_grid(spark, [cfg], w.NOW), _held_hours(spark, folder), [cfg], w.NOW)


@query
def retained_periods_hourly(spark, folder):
    """Stored hours that are not fetched again."""
    cfg = _named(w.HOURLY, refetch_recent_days=5)
    return retained_periods(history_grid(spark, [cfg], w.NOW), _held_hours(spark, folder), [cfg], w.NOW)


@query
def forecast_periods(spark, folder):
    """Series times periods of the last week."""
    cfg = _named(w.BY_TYPE)
    return forecast_grid(_points(spark, folder, cfg), cfg, w.NOW, start="7 days").select(*POINT, "period_index")


# --- versions --------------------------------------------------------------------


def _loads(spark, folder, name: str = w.BY_TYPE) -> tuple[DataFrame, DataFrame]:
    """First load with a partial last day, then a load of everything."""
    cfg = _named(name)
    before = replace(cfg, source_filter_sql=f"ts < TIMESTAMP_NTZ '{FIRST_LOAD}'")
    return tuple(new_versions(describe_source(_points(spark, folder, c), [cfg]), at)
                 for c, at in ((before, FIRST_LOAD), (cfg, SECOND_LOAD)))


VERSION = [*POINT, "value", "valid_from", "valid_to", "is_latest"]


def _shown(frame: DataFrame, *columns: str) -> DataFrame:
    """The end of an open version lies beyond what pandas timestamps can hold: show it as text."""
    return frame.select(*columns).withColumn("valid_to", F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss"))


def _upserted(spark, folder, name: str = w.BY_TYPE) -> DataFrame:
    first, second = _loads(spark, folder, name)
    return merge_versions(first, second, SECOND_LOAD)


@query
def row_keys(spark, folder):
    first, _ = _loads(spark, folder)
    return first.select(*POINT, "key", "source_sql_hash")


@query
def scd2_upsert(spark, folder):
    """The restated day gets a second version, new days a first one."""
    return _shown(_upserted(spark, folder), *VERSION)


@query
def scd2_noop(spark, folder):
    """Merging the same values again changes nothing."""
    once = _upserted(spark, folder)
    _, second = _loads(spark, folder)
    return _shown(merge_versions(once, second, datetime(2024, 2, 1)), *VERSION)


@query
def actuals_current(spark, folder):
    """Current stored values of one config."""
    return current_values(_upserted(spark, folder), w.BY_TYPE, "event_type",
                          ("config_name", "timestamp", "dimension_split_value", "value"))


@query
def tombstone_config(spark, folder):
    both = _upserted(spark, folder).unionByName(_upserted(spark, folder, w.TOTAL))
    return _shown(tombstone(both, w.TOTAL), *VERSION)


@query
def scd2_forecasts(spark, folder):
    """Forecast versions: the method is part of the key."""
    points = w.Monitoring.of(spark, folder).points().filter(F.col("config_name") == w.TOTAL)
    loads = []
    for days, at in ((3, FIRST_LOAD), (7, SECOND_LOAD)):
        configs = [cfg for cfg in w.event_configs(daily=days) if cfg.name == w.TOTAL]
        loads.append(new_versions(describe_source(_rounded(forecast(points, configs, w.NOW)), configs), at))
    return _shown(merge_versions(*loads, SECOND_LOAD), "forecast_method", *VERSION)


# --- forecasts -------------------------------------------------------------------

PRIORITY = "orders_by_priority_daily"


def _priority_forecast(spark, folder, algorithms: dict, **more) -> DataFrame:
    cfg = w.orders_config(PRIORITY, "COUNT(*)", algorithms, "o_orderkey", dimension_split="o_orderpriority", **more)
    return _rounded(forecast(_points(spark, folder, cfg), [cfg], w.ORDERS_NOW))


def _register_statistic(method: str) -> None:
    def run(spark, folder):
        return _priority_forecast(spark, folder, w._windows(**{method: 30}))
    run.__name__, run.__doc__ = f"forecast_{method}", f"{method} of the last 30 values before each of 90 days."
    query(run)


for _method in ("mean", "median", "max", "min", "sum"):
    _register_statistic(_method)


@query
def forecast_constant(spark, folder):
    return _priority_forecast(spark, folder, w._windows(constant_value=0.5))


@query
def forecast_all_methods(spark, folder):
    """Windows, a constant and several configs in one call."""
    monitoring = w.Monitoring.of(spark, folder)
    return _rounded(monitoring.forecasts(w.event_configs(), monitoring.points()))


@query
def forecast_nonnegative(spark, folder):
    """Negative forecasts become zero, or the largest value seen before."""
    algorithms = w._windows(mean=7, min=7, max=7)
    algorithms["mean"]["parameters"]["replace_negative_forecasts_by"] = "zero"
    algorithms["min"]["parameters"]["replace_negative_forecasts_by"] = "max"
    cfg = w.orders_config("orders_surplus_daily", "SUM(o_totalprice) - COUNT(*) * 250000", algorithms)
    return _rounded(forecast(_points(spark, folder, cfg), [cfg], w.ORDERS_NOW), 2)


@query
def forecast_deprecated_dims(spark, folder):
    """Retired dimensions are not trained on."""
    return _priority_forecast(spark, folder, w._windows(median=30), deprecated_dims=("1-URGENT", "5-LOW"))


@query
def forecast_mstl(spark, folder):
    """Multi-seasonal decomposition with yearly and weekly seasons."""
    algorithms = {"mstl": {"parameters": {"season_length": [365.25, 7]}}}
    cfg = w.orders_config("orders_price_daily", "SUM(o_totalprice)", algorithms)
    return _rounded(forecast(_points(spark, folder, cfg), [cfg], w.ORDERS_NOW), 2)


@query
def forecast_mstl_periods(spark, folder):
    """Which days get a decomposition: those after two of the longest season's worth of values."""
    configs = [w.orders_config(f"orders_season_{days}", "SUM(o_totalprice)", {"mstl": {"parameters": {"season_length": [days, 7]}}},
                               source_filter_sql="o_orderdate >= '2001-01-01'") for days in (30, 70)]
    return forecast(_points(spark, folder, *configs), configs, w.ORDERS_NOW).select(*POINT, "forecast_method")


@query
def forecast_without_training(spark, folder):
    """A metric without any point gets no forecast by any method, and the others theirs."""
    methods = {**w._windows(max=30, constant_value=2), "mstl": {"parameters": {"season_length": [7]}}}
    empty = w.orders_config("orders_none_daily", "COUNT(*)", methods, source_filter_sql="o_totalprice < 0")
    cfg = w.orders_config(PRIORITY, "COUNT(*)", w._windows(max=30), "o_orderkey", dimension_split="o_orderpriority")
    return _rounded(forecast(_points(spark, folder, empty, cfg), [empty, cfg], w.ORDERS_NOW))


# --- deltas ----------------------------------------------------------------------


def _versions(spark, folder) -> tuple[DataFrame, DataFrame]:
    monitoring, configs = w.Monitoring.of(spark, folder), w.event_configs()
    points = monitoring.points()
    predicted = monitoring.forecasts(configs, points)
    return tuple(new_versions(describe_source(rows, configs), w.NOW) for rows in (points, predicted))


@query
def deltas_full_join(spark, folder):
    """Actuals and forecasts side by side."""
    versions = _versions(spark, folder)
    return add_definitions(match_points(*versions), known_definitions(*versions)).select(
        *POINT, "forecast_method", "forecast_timestamp", "forecast_value", "actual_timestamp", "actual_value", "date",
        "source_dataset_table", "source_dataset_table_column", "period_length")


DELTA = [*POINT, "forecast_method", "forecast_value", "actual_value", "delta", "delta_rel", "abs_delta",
         "abs_delta_rel", "delta_rel_winsorised", "anomaly_type_lower_higher", "exceeded_threshold_lower_higher",
         "anomaly_type", "anomaly_value", "anomaly_value_windsorised"]


@query
def deltas_classified(spark, folder):
    """One metric from the source to the class of each point, nothing stored in between."""
    cfg = _named(w.BY_TYPE, algorithms=w._windows(median=7))
    points = _points(spark, folder, cfg)
    actuals = new_versions(describe_source(points, [cfg]), w.NOW)
    predicted = new_versions(describe_source(forecast(points, [cfg], w.NOW), [cfg]), w.NOW)
    return build_deltas(actuals, predicted, w.thresholds(spark), w.descriptions(spark), w.NOW, fine_grained=False,
                        keep=lambda frame, label: frame).select(*DELTA)


STORED = (w.BY_TYPE, w.TOTAL)
FORECAST_AHEAD = datetime(2024, 1, 23)


def _ingested(spark, folder) -> str:
    """Where two ingest runs left their tables: one with a partial last day, then a delta load that refetches it."""
    m = w.Monitoring.of(spark, folder)
    if m.ingested is None:
        root = _new_folder(spark, "ingest")
        configs = [_named(name, refetch_recent_days=12) for name in STORED]
        events = w.table(spark, folder, "events")
        limits, texts = w.thresholds(spark), w.descriptions(spark)
        for as_of, delta_load, ahead in ((FIRST_LOAD, False, FORECAST_AHEAD), (SECOND_LOAD, True, None)):
            ingest_run(spark, configs, lambda _, at=as_of: events.filter(F.col("ts") < F.lit(at)), limits, texts, root, as_of,
                       delta_load, forecast_to=ahead)
        m.ingested = root
    return m.ingested


@query
def actuals_stored(spark, folder):
    """Versions of the actuals after a full load and a delta load."""
    return _shown(read_partitioned(spark, f"{_ingested(spark, folder)}/actuals", ACTUALS), *VERSION)


@query
def forecasts_stored(spark, folder):
    """Versions of the forecasts: those made ahead of a partial day are replaced."""
    return _shown(read_partitioned(spark, f"{_ingested(spark, folder)}/forecasts", FORECASTS), "forecast_method", *VERSION)


@query
def deltas_stored(spark, folder):
    """Stored deltas, brought up to date by the second run."""
    return spark.read.parquet(f"{_ingested(spark, folder)}/deltas").select(
        *DELTA, "anomaly_type_lower_higher_start", "anomaly_type_lower_higher_end")


@query
def deltas_table(spark, folder):
    """All metrics of the deployment with bounds and descriptions."""
    return w.Monitoring.of(spark, folder).deltas().select(
        *DELTA, *[F.round(f"{n}_value", 6).alias(f"{n}_value") for n in ("critical_lower", "warning_higher")],
        *[F.round(f"{n}_delta_threshold", 6).alias(f"{n}_delta_threshold") for n in ("warning_lower", "critical_higher")],
        "description", "dq_dashboard_url", "text_inject")


@query
def deltas_debounced(spark, folder):
    """Where anomalies start and end."""
    return w.Monitoring.of(spark, folder).deltas().select(
        *POINT, "forecast_method", "anomaly_type_lower_higher", "anomaly_type_lower_higher_start",
        "anomaly_type_lower_higher_end", "anomaly_value_windsorised_debounced", "anomaly_value_debounced",
        "actual_value_debounced")


@query
def actuals_not_stale(spark, folder):
    """Metrics that stopped long ago are left out."""
    configs = [_named(w.BY_TYPE), w.orders_config(PRIORITY, "COUNT(*)", {}, dimension_split="o_orderpriority")]
    rows = new_versions(describe_source(_points(spark, folder, *configs), configs), w.NOW)
    return live_actuals(rows, w.NOW).select(*POINT, "value")


@query
def deltas_drop_future(spark, folder):
    """Forecasts up to the newest actual only; the run forecasts three days ahead."""
    monitoring, configs = w.Monitoring.of(spark, folder), w.event_configs()
    points = monitoring.points()
    ahead = forecast(points, configs, w.NOW, end=datetime(2024, 2, 3))
    actuals = new_versions(describe_source(points, configs), w.NOW)
    return _rounded(due_forecasts(ahead, newest_actuals(actuals))).select(*POINT, "forecast_method", "value")


ROW = [*th.THREAD, *th.KEY, "timestamp", "anomaly_type_lower_higher", "forecast_value", "actual_value", "delta_rel"]


@query
def deltas_latest_per_key(spark, folder):
    return th.latest_per_key(th.dated(w.Monitoring.of(spark, folder).deltas())
                             .filter(F.col("forecast_method").isNotNull())).select(*ROW)


@query
def deltas_keys_of_interest(spark, folder):
    """Newest row of every key that was anomalous or belongs to an open incident."""
    m = w.Monitoring.of(spark, folder)
    return th.rows_of_interest(m.deltas(), m.incidents(), w.NOW).select(*ROW)


@query
def bucket_counts(spark, folder):
    """Anomalies per thread and class with the worst class."""
    rows = th.latest_per_key(th.dated(w.Monitoring.of(spark, folder).deltas()))
    rank = F.when(F.col("anomaly_type") == "critical", 2).when(F.col("anomaly_type") == "warning", 1).otherwise(0)
    counted = rows.groupBy(*th.THREAD).agg(*th.bucket_counts(), F.max(rank).alias("severity_rank"))
    return counted.withColumn("counts_json", th.counts_json())


# --- incidents -------------------------------------------------------------------


def _run(spark, folder, **options):
    m = w.Monitoring.of(spark, folder)
    return alert_run(m.deltas(), m.incidents(), m.events(), w.channels(spark), w.event_configs(), w.NOW,
                     w.ENVIRONMENT, w.REPORT, w.PAGE, **options)


@query
def channel_routing(spark, folder):
    """Own channel, shared channel, or none, per environment."""
    routed = None
    for environment in ("dev", "staging", "prod"):
        threads = w.Monitoring.of(spark, folder).deltas().select("config_name").distinct()
        part = th.route_channels(threads, w.channels(spark), environment).withColumn("environment", F.lit(environment))
        routed = part if routed is None else routed.unionByName(part)
    return routed


@query
def first_seen_configs(spark, folder):
    m = w.Monitoring.of(spark, folder)
    return th.first_seen_configs(th.rows_of_interest(m.deltas(), m.incidents(), w.NOW), m.incidents())


INCIDENT = ["config_name", "anomaly_date", "slack_channel_id", "slack_ts", "opened_at", "closed_at", "status",
            "summary_counts_json"]


@query
def bootstrap_incidents(spark, folder):
    """Markers for the history of a metric that has no incidents yet."""
    m = w.Monitoring.of(spark, folder)
    rows = th.rows_of_interest(m.deltas(), m.incidents(), w.NOW)
    return th.bootstrap_incidents(rows, m.incidents(), w.NOW).select(*INCIDENT)


@query
def incidents_suppressed_keys(spark, folder):
    """Rows left after bootstrapped and silenced threads are dropped."""
    m = w.Monitoring.of(spark, folder)
    return relevant_rows(m.deltas(), m.incidents(), w.NOW).select(*ROW)


@query
def silenced_keys(spark, folder):
    return th.silenced_threads(w.Monitoring.of(spark, folder).incidents(), w.NOW)


@query
def incident_lookup(spark, folder):
    """The incident a thread continues, if any."""
    return th.find_incidents(w.Monitoring.of(spark, folder).incidents(), w.NOW).select(*INCIDENT)


@query
def announced_state(spark, folder):
    return tr.announced_states(w.Monitoring.of(spark, folder).events()).select(
        "incident_slack_ts", *th.KEY, "announced_kind", "posted_at", "announced")


def _state(spark, folder) -> tuple[DataFrame, DataFrame]:
    m = w.Monitoring.of(spark, folder)
    rows = relevant_rows(m.deltas(), m.incidents(), w.NOW)
    state = thread_states(rows, m.incidents(), w.channels(spark), w.event_configs(), w.NOW, w.ENVIRONMENT)
    return rows, state


@query
def threads_visited(spark, folder):
    """Threads with their incident, mode, channel and what fires."""
    _, state = _state(spark, folder)
    return state.select(*th.THREAD, "mode", "slack_channel_id", "has_anomaly", "severity", "reopened", "hard_cap",
                        "incident_slack_ts")


@query
def reopened_incidents(spark, folder):
    _, state = _state(spark, folder)
    return state.filter("reopened").select(*th.THREAD, "incident_slack_ts")


@query
def incident_transitions(spark, folder):
    """Fire, severity change and resolve per key, with the projected class."""
    rows, state = _state(spark, folder)
    keys = tr.key_states(state, rows, w.Monitoring.of(spark, folder).events())
    return keys.filter("is_projected").select(*th.THREAD, *th.KEY, "current", "announced", "transition", "projected")


ACTION = [*th.THREAD, "kind", "phase", *th.KEY, "mode", "slack_channel_id", "incident_slack_ts"]


@query
def incident_openings(spark, folder):
    """New threads with severity, counts or the first firing row."""
    opened = _run(spark, folder).actions.filter(F.col("kind") == tr.OPEN)
    return opened.select(*th.THREAD, "mode", "slack_channel_id", "severity", *tr.BUCKETS, "has_counts",
                         "has_fire_card", *th.KEY, "anomaly_type_lower_higher", "timestamp", "delta_rel")


@query
def incident_summaries(spark, folder):
    """Threads whose counts changed, before the mode filter."""
    return _run(spark, folder).actions.filter(F.col("kind") == tr.SUMMARY).select(
        *th.THREAD, "mode", "incident_slack_ts", *tr.BUCKETS)


@query
def incident_closures(spark, folder):
    return _run(spark, folder).actions.filter(F.col("kind") == tr.CLOSE).select(
        *th.THREAD, "incident_slack_ts", "reason")


@query
def actions_by_mode(spark, folder):
    """All actions of the run and whether the mode shows them."""
    return _run(spark, folder).actions.select(*ACTION, "visible")


@query
def incidents_after_run(spark, folder):
    return _run(spark, folder).incidents.select(*INCIDENT)


@query
def events_after_run(spark, folder):
    """Reply events the run appends."""
    return _run(spark, folder).events.select(
        "incident_slack_ts", "config_name", *th.KEY, (F.col("slack_ts").isNotNull().cast("int")).alias("has_message"),
        "slack_channel_id", "kind", "anomaly_type_lower_higher", "previous_anomaly_type_lower_higher",
        "anomaly_timestamp", "posted_at", "client_msg_id")


@query
def events_after_run_parity(spark, folder):
    """The same without the transitions that a mode hides."""
    return _run(spark, folder, parity=True).events.groupBy("config_name", "kind").agg(
        F.count(F.lit(1)).alias("events"))


def _written_runs(spark, folder) -> str:
    """Where the tables of a deployment are after a run was written, and the same run was decided and written again."""
    m = w.Monitoring.of(spark, folder)
    if m.alerting is None:
        root = _new_folder(spark, "alerting")
        write_partitioned(m.incidents(), f"{root}/incidents", "opened_at")
        write_partitioned(m.events(), f"{root}/events", "posted_at")
        for _ in range(2):
            incidents, events, known = live_tables(spark, root, w.NOW)
            write_run(alert_run(m.deltas(), incidents, events, w.channels(spark), w.event_configs(), w.NOW, w.ENVIRONMENT,
                                w.REPORT, w.PAGE, known=known), root)
        m.alerting = root
    return m.alerting


def _new_folder(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query
def incidents_stored(spark, folder):
    """The incident table as two equal runs left it."""
    return alert_tables(spark, _written_runs(spark, folder))[0].select(*INCIDENT)


@query
def events_stored(spark, folder):
    """The event log as two equal runs left it: the history and, once, what the run adds."""
    events = alert_tables(spark, _written_runs(spark, folder))[1]
    return events.select("incident_slack_ts", *[F.coalesce(name, F.lit("")).alias(name) for name in th.KEY], "kind",
                         "posted_at", "client_msg_id")


@query
def outbox_stored(spark, folder):
    """Messages in the order of their delivery, each once."""
    return read_partitioned(spark, f"{_written_runs(spark, folder)}/outbox", OUTBOX).select(
        "action_seq", *th.THREAD, "kind", *th.KEY, "slack_channel_id", "thread_id", "decided_at")


@query
def replay_actions(spark, folder):
    """Deltas exported to JSON files and replayed: no suppression, no open threads, no history."""
    return _replayed(spark, folder).actions.filter("visible").select(*ACTION)


@query
def replay_undated_rows(spark, folder):
    """Replayed rows without a date belong to no thread and are rejected; here those of one method."""
    stamp = F.when(F.col("forecast_method") != "mean", F.col("timestamp"))
    return _replayed(spark, folder, timestamp=stamp).undated.select("config_name", *th.KEY)


def _replayed(spark, folder, **changes):
    m, path = w.Monitoring.of(spark, folder), _new_folder(spark, "export")
    exported = m.deltas().filter(F.col("anomaly_type") != "normal").select(
        *POINT, "forecast_method", "anomaly_type_lower_higher", "forecast_value", "actual_value", "delta_rel",
        "description", "dq_dashboard_url", "text_inject", "source_sql")
    exported.withColumns(changes).write.json(path)
    return alert_run(read_replay(spark, path, lines=True), m.incidents().filter(F.lit(False)), m.events().filter(F.lit(False)),
                     w.channels(spark), w.event_configs(), w.NOW, w.ENVIRONMENT, replay=True)


@query
def dry_run(spark, folder):
    """What a run would show, by kind, and what the tables hold after it was decided and not written."""
    m, root = w.Monitoring.of(spark, folder), _new_folder(spark, "dry-run")
    write_partitioned(m.incidents(), f"{root}/incidents", "opened_at")
    write_partitioned(m.events(), f"{root}/events", "posted_at")
    incidents, events, known = live_tables(spark, root, w.NOW)
    run = alert_run(m.deltas(), incidents, events, w.channels(spark), w.event_configs(), w.NOW, w.ENVIRONMENT, w.REPORT, w.PAGE,
                    known=known)
    counted = run.shown.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    for name, table in zip(("incidents", "events"), alert_tables(spark, root)):
        counted = counted.union(table.agg(F.lit(name), F.count(F.lit(1))))
    outbox = read_partitioned(spark, f"{root}/outbox", OUTBOX)
    return counted.union(outbox.agg(F.lit("outbox"), F.count(F.lit(1))))


@query
def seed_thresholds(spark, folder):
    """Thresholds written to CSV, with empty fields, and read as a seed."""
    spread = F.round(F.max("value") - F.min("value"), 4)
    limits = w.Monitoring.of(spark, folder).points().groupBy("config_name").agg(
        F.lit("median").alias("forecast_method"), (-spread).alias("critical_lower"), spread.alias("critical_higher"),
        F.when(F.count(F.lit(1)) > 100, -spread / 4).alias("warning_lower"), F.lit(None).cast("double").alias("warning_higher"))
    root = _new_folder(spark, "seeds")
    limits.write.csv(f"{root}/thresholds_dev.csv", header=True)
    return read_thresholds(spark, root, "dev")


@query
def seed_descriptions(spark, folder):
    """Texts with quotes, commas and line breaks written to CSV and read as a seed; empty ones are NULL."""
    text = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n'), "p_type")
    rows = w.table(spark, folder, "part").select(
        F.concat(F.lit("part-"), "p_partkey").alias("config_name"), text.alias("description"),
        F.when(F.col("p_size") > 25, F.lit("")).otherwise(F.lit("https://dq.example/?a=1,2")).alias("dq_dashboard_url"),
        F.lit(None).cast("string").alias("text_inject"))
    root = _new_folder(spark, "seeds")
    rows.write.csv(f"{root}/config_descriptions_dev.csv", header=True, quote='"', escape='"', emptyValue="")
    return read_descriptions(spark, root, "dev")


@query
def close_config_incidents(spark, folder):
    return analysis.close_open_incidents(w.Monitoring.of(spark, folder).incidents(), w.BY_TYPE, w.NOW).select(*INCIDENT)


@query
def unbootstrap_config(spark, folder):
    return analysis.without_bootstrap(w.Monitoring.of(spark, folder).incidents(), w.BY_TYPE).select(*INCIDENT)


# --- messages --------------------------------------------------------------------


@query
def dashboard_links(spark, folder):
    """A link per metric, method and dimension."""
    keys = w.Monitoring.of(spark, folder).deltas().select(
        "config_name", F.coalesce("forecast_method", F.lit("")).alias("forecast_method"),
        "dimension_split_value").distinct()
    return keys.withColumn("link", dashboard_link(w.REPORT, w.PAGE, *[F.col(c) for c in keys.columns]))


@query
def outbox_messages(spark, folder):
    """Text of every message of the run."""
    return _run(spark, folder).outbox


# --- analysis --------------------------------------------------------------------


def _publications(spark, folder) -> DataFrame:
    """Shipments as publications: the delay runs from order to shipment."""
    orders, lines = w.table(spark, folder, "orders"), w.table(spark, folder, "lineitem")
    both = lines.select("l_orderkey", "l_shipdate").join(
        orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    hours = F.timestamp_diff("HOUR", F.col("o_orderdate"), F.col("l_shipdate")).cast("double")
    return both.select(
        F.col("o_orderpriority").alias("dataset"), F.col("o_orderstatus").alias("environment"),
        F.to_date("l_shipdate").alias("date"), F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.lit("DAY").alias("date_interval"), F.lit("1995-06-01").cast("date").alias("first_valid_from_date"),
        F.when(hours >= 0, hours).alias("timestamp_delay_hour"),
        (hours - 40000).alias("timestamp_delay_now_hypothetical_vs_expected_delay_hour"))


@query
def publication_lags(spark, folder):
    return analysis.publication_lags(_publications(spark, folder), datetime(2001, 11, 5), exact=True)


@query
def environment_comparison(spark, folder):
    return analysis.environment_comparison(_publications(spark, folder), ("F", "O"), exact=True)


@query
def dedup_new_hashes(spark, folder):
    """Hashes to append: observed anomalies and predicted delays the index lacks."""
    m = w.Monitoring.of(spark, folder)
    predicted = analysis.predicted_delay_anomalies(_publications(spark, folder), "publication_delays", "F")
    critical = m.deltas().filter(F.col("anomaly_type") == "critical")
    empty = spark.createDataFrame([], "event_hash string, processed_at timestamp")
    index = analysis.new_event_hashes(critical, empty, w.NOW)
    return analysis.new_event_hashes(m.deltas(), index, w.NOW, predicted)


@query
def dedup_stored(spark, folder):
    """The index after the critical events, then all of them, twice, were appended."""
    m = w.Monitoring.of(spark, folder)
    path = _new_folder(spark, "dedup")
    predicted = analysis.predicted_delay_anomalies(_publications(spark, folder), "publication_delays", "F")
    for deltas, more in ((m.deltas().filter(F.col("anomaly_type") == "critical"), None), (m.deltas(), predicted),
                         (m.deltas(), predicted)):
        index = read_partitioned(spark, path, DEDUP_INDEX)
        analysis.append_hashes(analysis.new_event_hashes(deltas, index, w.NOW, more), path)
    return read_partitioned(spark, path, DEDUP_INDEX).select(*DEDUP_INDEX.names)


# --- status views ----------------------------------------------------------------


@query
def current_state(spark, folder):
    return analysis.current_state(w.Monitoring.of(spark, folder).deltas())


@query
def config_rollup(spark, folder):
    return analysis.config_rollup(w.Monitoring.of(spark, folder).deltas())


@query
def product_rollup(spark, folder):
    products = w.small(spark, w.PRODUCT_ROWS, w.PRODUCTS)
    return analysis.product_rollup(w.Monitoring.of(spark, folder).deltas(), products)


@query
def severity_ribbon_14d(spark, folder):
    return analysis.severity_ribbon(w.Monitoring.of(spark, folder).deltas(), w.NOW)


@query
def count_drift(spark, folder):
    m = w.Monitoring.of(spark, folder)
    return analysis.count_drift(m.incidents(), m.events())


@query
def stale_dimensions(spark, folder):
    """Customers whose last order is at least 30 days behind the newest order."""
    cfg = w.orders_config("orders_by_customer", "COUNT(*)", {}, "o_orderkey", dimension_split="o_custkey")
    return analysis.stale_dimensions(_points(spark, folder, cfg), 30, "day")


# --- streams ---------------------------------------------------------------------


@query
def stream_metric_points(spark, folder):
    """Daily counts by type, kept up to date as events arrive."""
    return streams.run_metric_points(spark, folder, "events.parquet", _named(w.BY_TYPE))


@query
def stream_final_points(spark, folder):
    """Hourly sums, emitted only once they are three hours old."""
    return _rounded(streams.run_final_points(spark, folder, "events.parquet", _named(w.HOURLY), "3 hours"), 2)


@query
def stream_versions(spark, folder):
    """Versioned daily counts maintained by merging each micro-batch."""
    return streams.run_versions(spark, folder, "events.parquet", _named(w.TOTAL), w.NOW).select(*VERSION[:4], "is_latest")


@query
def stream_announced_state(spark, folder):
    """Last announced class per key from the event log."""
    path = _new_folder(spark, "event-log")
    write_partitioned(w.Monitoring.of(spark, folder).events(), path, "posted_at")
    return streams.run_announced_state(spark, path)


@query
def stream_points_resumed(spark, folder):
    """Daily counts by type: a stream that ended and went on when more events had arrived."""
    return _in_two_parts(spark, folder, "points", lambda path, location: streams.run_metric_points(
        spark, path, "*.parquet", _named(w.BY_TYPE), location=location))


@query
def stream_versions_resumed(spark, folder):
    """Versions of daily counts: the day that was cut by the end of the first part has two."""
    start = w.NOW - timedelta(hours=1)
    versions = _in_two_parts(spark, folder, "versions", lambda path, location: streams.run_versions(
        spark, path, "*.parquet", _named(w.TOTAL), lambda number: start + timedelta(minutes=number), location=location))
    return versions.select(*VERSION[:4], "is_latest")


def _in_two_parts(spark, folder, label: str, run: Callable[[str, str], DataFrame]) -> DataFrame:
    """Result of the second of two calls of ``run``; events from the cut on arrive between them."""
    arrived, location = _new_folder(spark, f"arriving-{label}"), _new_folder(spark, f"resumed-{label}")
    events, late = w.table(spark, folder, "events"), F.col("ts") >= F.lit(STREAM_CUT)
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(arrived)
        result = run(arrived, location)
    return result


@query
def stream_distinct_hashes(spark, folder):
    """Event hashes without repeats inside the 60-day window."""
    return streams.run_distinct_hashes(spark, folder, "events.parquet")
