"""One alerting run: from deltas and the incident log to actions and new tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch.config import THREAD as THREAD_MODE, MetricConfig
from tidewatch.functions.periods import timestamp_literal
from tidewatch.operators.messages import outbox
from tidewatch.operators.threads import (
    LOOKBACK, THREAD, bootstrap_incidents, counts_json, first_seen_configs, latest_per_key, live_months, rejected_rows,
    route_channels, rows_of_interest, threads_to_visit, without_suppressed,
)
from tidewatch.operators.transitions import (
    CLOSE, OPEN, SUMMARY, TRANSITIONS, attach_incidents, in_order, is_visible, key_states, list_actions, message_identity,
    project_threads,
)
from tidewatch.schemas import INCIDENTS, OUTBOX, REPLY_EVENTS
from tidewatch.session import scratch, stored
from tidewatch.sources.tables import append_new, list_folders, month_of, read_partitioned, remove_folders, write_partitioned


@dataclass
class AlertRun:
    """Results of a run, each built when asked for; nothing is written until ``write_run`` or the caller does so."""

    actions: DataFrame  # everything the state machine decided; see ``visible``
    rejected: DataFrame  # threads without a channel
    undated: DataFrame  # rows without a date
    before: DataFrame
    reopened: DataFrame
    markers: DataFrame | None
    as_of: datetime
    environment: str
    report: str
    page: str
    parity: bool
    known: DataFrame | None = None  # names of configs with incidents that ``before`` need not hold

    @property
    def shown(self) -> DataFrame:
        return self.actions.filter("visible")

    @cached_property
    def incidents(self) -> DataFrame:
        """The incident table after the run."""
        after = incidents_after(self.before, self.shown, self.reopened, self.as_of)
        return after if self.markers is None else after.unionByName(self.markers.select(*INCIDENTS.names))

    @cached_property
    def events(self) -> DataFrame:
        """Reply events to append."""
        hidden = F.col("kind").isin(*TRANSITIONS)
        return events_of(self.shown if self.parity else self.actions.filter(F.col("visible") | hidden), self.as_of)

    @cached_property
    def outbox(self) -> DataFrame:
        """Messages to deliver."""
        return outbox(self.shown, self.environment, self.report, self.page)


def aggregation_mode(configs: Iterable[MetricConfig]) -> Column:
    modes = [F.lit(item) for cfg in configs for item in (cfg.name, cfg.mode)]
    if not modes:
        return F.lit(THREAD_MODE)
    return F.coalesce(F.try_element_at(F.create_map(*modes), F.col("config_name")), F.lit(THREAD_MODE))


def relevant_rows(deltas: DataFrame, incidents: DataFrame, as_of: datetime, replay: bool = False) -> DataFrame:
    """Newest rows of the threads to look at, without suppressed threads."""
    if replay:
        rows = deltas.withColumns({
            "anomaly_date": F.coalesce("anomaly_date", F.to_date("timestamp"))
            if "anomaly_date" in deltas.columns else F.to_date("timestamp"),
            "dimension_split_value": F.coalesce("dimension_split_value", F.lit("")),
            "forecast_method": F.coalesce("forecast_method", F.lit("")),
        })
        return latest_per_key(rows)
    return without_suppressed(rows_of_interest(deltas, incidents, as_of), incidents, as_of)


def thread_states(rows: DataFrame, incidents: DataFrame, channels: DataFrame, configs: Iterable[MetricConfig],
                  as_of: datetime, environment: str, replay: bool = False) -> DataFrame:
    """State of every thread to visit; ``slack_channel_id`` is NULL where no channel is mapped."""
    visited = threads_to_visit(rows, incidents, as_of, open_too=not replay)
    routed = route_channels(visited, channels, environment).withColumn("mode", aggregation_mode(configs))
    return attach_incidents(routed, rows, incidents, as_of)


def incidents_after(incidents: DataFrame, actions: DataFrame, reopened: DataFrame, as_of: datetime) -> DataFrame:
    """Insert opened incidents, then apply reopening, new counts and closing.

    One pass over the table for all updates of a run.  Closing wins over
    reopening, as it is applied last.
    """
    now = timestamp_literal(as_of)
    opened = actions.filter(F.col("kind") == OPEN).select(
        *THREAD, "slack_channel_id", F.col("incident_slack_ts").alias("slack_ts"), now.alias("opened_at"),
        F.lit(None).cast("timestamp").alias("closed_at"), F.lit("open").alias("status"),
        F.md5(F.concat(F.lit("parent|"), "incident_slack_ts")).alias("client_msg_id"),
        counts_json().alias("summary_counts_json"))
    updates = (
        actions.filter(F.col("kind").isin(SUMMARY, CLOSE))
        .select("incident_slack_ts", F.when(F.col("kind") == SUMMARY, counts_json()).alias("_counts"),
                (F.col("kind") == CLOSE).alias("_close"), F.lit(False).alias("_reopen"))
        .unionByName(reopened.select("incident_slack_ts", F.lit(None).cast("string").alias("_counts"),
                                     F.lit(False).alias("_close"), F.lit(True).alias("_reopen")))
        .groupBy("incident_slack_ts")
        .agg(F.max("_counts").alias("_counts"), F.bool_or("_close").alias("_close"),
             F.bool_or("_reopen").alias("_reopen")))
    table = incidents.select(*INCIDENTS.names).unionByName(opened)
    joined = table.join(updates, F.col("slack_ts") == F.col("incident_slack_ts"), "left")
    return joined.withColumns({
        "status": F.when(F.col("_close"), "resolved").when(F.col("_reopen"), "open").otherwise(F.col("status")),
        "closed_at": F.when(F.col("_close"), now).when(~F.coalesce("_reopen", F.lit(False)), F.col("closed_at")),
        "summary_counts_json": F.coalesce("_counts", "summary_counts_json"),
    }).select(*INCIDENTS.names)


def events_of(actions: DataFrame, as_of: datetime) -> DataFrame:
    """Reply events of the actions; one without a message has no ``slack_ts``."""
    def unless_empty(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name))

    logged = actions.filter(F.col("kind").isin(*TRANSITIONS, SUMMARY))
    return logged.select(
        "incident_slack_ts", "config_name", unless_empty("dimension_split_value").alias("dimension_split_value"),
        unless_empty("forecast_method").alias("forecast_method"),
        F.when(F.col("visible"), message_identity(as_of)).alias("slack_ts"), "slack_channel_id", "kind",
        "anomaly_type_lower_higher", "previous_anomaly_type_lower_higher",
        F.col("timestamp").alias("anomaly_timestamp"), timestamp_literal(as_of).alias("posted_at"),
        message_identity(as_of).alias("client_msg_id")).select(*REPLY_EVENTS.names)


def alert_run(deltas: DataFrame, incidents: DataFrame, events: DataFrame, channels: DataFrame,
              configs: Iterable[MetricConfig], as_of: datetime, environment: str, report: str = "", page: str = "",
              replay: bool = False, parity: bool = False, known: DataFrame | None = None) -> AlertRun:
    """Decide a run.  Using only ``actions`` of the result is a dry run.

    ``incidents`` may leave out what ``live_tables`` leaves out; ``known`` then names the configs that had incidents.

    Transitions a mode does not show are still logged, without a message, so
    that later runs know what was announced; ``parity=True`` drops them.
    The rows, threads and keys of the run are stored once in the shared
    checkpoint folder: every output is a projection of them, and the outputs
    stay consistent while the tables they came from are being replaced.
    """
    configs = list(configs)
    rows = stored(relevant_rows(deltas, incidents, as_of, replay), "alert-rows")
    undated = rejected_rows(rows)
    rows = rows.filter(F.col("anomaly_date").isNotNull())
    markers = None
    if not replay:
        markers = bootstrap_incidents(rows, incidents, as_of, known)
        fresh = first_seen_configs(rows, incidents, known).withColumn("_fresh", F.lit(True))
        rows = (rows.join(fresh, "config_name", "left")
                .filter(F.col("_fresh").isNull() | (F.col("anomaly_date") >= F.lit(as_of.date()))).drop("_fresh"))
    state = stored(thread_states(rows, incidents, channels, configs, as_of, environment, replay), "alert-threads")
    rejected = state.filter(F.col("slack_channel_id").isNull()).select(*THREAD)
    state = state.filter(F.col("slack_channel_id").isNotNull())
    keys = stored(key_states(state, rows, events, as_of), "alert-keys")
    actions = list_actions(project_threads(state, keys), keys, as_of).withColumn("visible", is_visible())
    reopened = state.filter("reopened").select("incident_slack_ts")
    return AlertRun(actions, rejected, undated, incidents, reopened, markers, as_of, environment, report, page, parity,
                    known)


INCIDENTS_ORDER, EVENTS_ORDER = ("config_name", "anomaly_date"), ("incident_slack_ts", "dimension_split_value", "forecast_method")


def alert_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Incidents and reply events as ``write_run`` leaves them; empty before the first run."""
    return (read_partitioned(spark, f"{root}/incidents", INCIDENTS).select(*INCIDENTS.names),
            read_partitioned(spark, f"{root}/events", REPLY_EVENTS).select(*REPLY_EVENTS.names))


# What runs know about months they do not read: ``month`` (has to be read) or ``config`` (has had an incident), and the value.
LIVE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])


def live_tables(spark: SparkSession, root: str, as_of: datetime) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """What a run at ``as_of`` has to see of the tables below ``root``: incidents, events, and ``known`` for ``alert_run``.

    Incidents are read from the months of the lookback and those that hold threads still open; months of events are pruned
    by ``alert_run``, through the ``month`` they keep.  Tables that ``write_run`` has not written yet are read whole.
    Incidents and events without a stamp belong to no month and are left out.
    """
    incidents = read_partitioned(spark, f"{root}/incidents", INCIDENTS)
    events = read_partitioned(spark, f"{root}/events", REPLY_EVENTS)
    live = read_partitioned(spark, f"{root}/live", LIVE, ("run",))
    months = [row[0] for row in live.filter("kind = 'month'").select("value").distinct().collect()]  # one row per month
    if not months:
        return incidents.select(*INCIDENTS.names), events, None
    wanted = F.col("month").isin(months) | (F.col("month") >= (as_of - LOOKBACK).strftime("%Y-%m"))
    known = live.filter("kind = 'config'").select(F.col("value").alias("config_name")).distinct()
    return incidents.filter(wanted).select(*INCIDENTS.names), events, known


def _note_live(run: AlertRun, path: str) -> str:
    """Write what later runs need to know about months they will not read; gives the name of this note.

    Notes add up, so while a run is being written the one of the run before it stays.
    """
    now = run.as_of.strftime("%Y-%m")
    months = live_months(run.incidents, run.as_of).select(F.lit("month").alias("kind"), F.col("month").alias("value"))
    names = run.incidents.select("config_name") if run.known is None else run.incidents.select("config_name").union(run.known)
    configs = names.filter("config_name IS NOT NULL").select(F.lit("config").alias("kind"), F.col("config_name").alias("value"))
    current = run.actions.sparkSession.range(1).select(F.lit("month").alias("kind"), F.lit(now).alias("value"))
    rows, name = months.union(current).union(configs).distinct(), uuid.uuid4().hex
    rows.write.parquet(f"{path}/run={name}")
    return name


def write_run(run: AlertRun, root: str) -> None:
    """Write a run that was decided on ``live_tables`` or ``alert_tables`` of the same ``root``: outbox, events, incidents.

    Messages and events have ids and are appended once; of the incidents only
    the months with a change are replaced.  The incidents come last: a run that
    breaks off is finished by deciding and writing it again with the same
    ``as_of``.  One run at a time writes to a ``root``.
    """
    spark, now = run.actions.sparkSession, timestamp_literal(run.as_of)
    with scratch(spark, "write-run"):
        messages = outbox(in_order(run.shown), run.environment, run.report, run.page).withColumn("decided_at", now)
        append_new(messages, f"{root}/outbox", OUTBOX, "decided_at",
                   ["decided_at", "thread_id", "kind", "dimension_split_value", "forecast_method"])
        append_new(run.events, f"{root}/events", REPLY_EVENTS, "posted_at", ["client_msg_id"], EVENTS_ORDER)
        changed = run.shown.filter(F.col("kind").isin(OPEN, SUMMARY, CLOSE)).select("incident_slack_ts").unionByName(run.reopened)
        older = run.before.join(changed, F.col("slack_ts") == F.col("incident_slack_ts"), "left_semi")
        months = {row[0] for row in older.select(month_of("opened_at")).distinct().collect()}  # one row per month
        months = sorted(month for month in months | {run.as_of.strftime("%Y-%m")} if month)
        after = stored(run.incidents.filter(month_of("opened_at").isin(months)), "incidents")
        note = _note_live(run, f"{root}/live")
        write_partitioned(after, f"{root}/incidents", "opened_at", INCIDENTS_ORDER)
        remove_folders(spark, [path for path in list_folders(spark, f"{root}/live") if not path.endswith(f"run={note}")])
