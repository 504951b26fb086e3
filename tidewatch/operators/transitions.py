"""State transitions of incident threads, for all threads at once.

The newest row of each key is compared with what was last announced for it.
A full outer join of both sides gives every transition; aggregates per thread
give counts, severity, summaries and closures.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.config import FLAT, FLAT_WITH_RESOLVE, THREAD as THREAD_MODE
from tidewatch.functions.periods import timestamp_literal
from tidewatch.operators.actuals import SANE_FROM
from tidewatch.operators.deltas import BUCKETS, NORMAL
from tidewatch.operators.threads import HARD_CAP, KEY, THREAD, bucket_counts, find_incidents
from tidewatch.session import stored

OPEN, FIRE, CHANGE, RESOLVE, SUMMARY, CLOSE = (
    "open_thread", "fire", "severity_change", "resolve", "summary", "close_thread")
TRANSITIONS = (FIRE, CHANGE, RESOLVE)
# Actions in the order in which they are applied within a thread.
PHASES = {OPEN: 0, FIRE: 1, CHANGE: 1, RESOLVE: 1, SUMMARY: 2, CLOSE: 3}
VISIBLE = {
    THREAD_MODE: (OPEN, FIRE, CHANGE, RESOLVE, SUMMARY, CLOSE),
    FLAT_WITH_RESOLVE: (OPEN, CHANGE, RESOLVE, CLOSE),
    FLAT: (OPEN, CLOSE),
}
ROW_COLUMNS = ["timestamp", "forecast_value", "actual_value", "delta_rel", "source_sql"]
COUNTS = T.StructType([T.StructField(bucket, T.LongType()) for bucket in BUCKETS])


def announced_states(events: DataFrame) -> DataFrame:
    """Last announcement per incident, dimension and method; summaries do not count.

    Of events posted at the same instant the first logged one stands.
    """
    named = events.filter(F.col("kind") != SUMMARY).withColumns({
        name: F.coalesce(name, F.lit("")) for name in KEY})
    newest = Window.partitionBy("incident_slack_ts", *KEY).orderBy(F.desc("posted_at"), F.asc("client_msg_id"))
    last = named.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
    state = F.when(F.col("kind") == RESOLVE, F.lit(NORMAL)).otherwise(F.col("anomaly_type_lower_higher"))
    return last.select("incident_slack_ts", *KEY, F.col("kind").alias("announced_kind"), "posted_at",
                       state.alias("announced"))


def firing(column: str = "anomaly_type_lower_higher") -> Column:
    return F.coalesce(F.col(column) != NORMAL, F.lit(False)) & (F.coalesce(F.col(column), F.lit("")) != "")


def attach_incidents(threads: DataFrame, rows: DataFrame, incidents: DataFrame, as_of: datetime) -> DataFrame:
    """Thread state: its incident, whether it is reopened, capped, and what fires.

    A recently resolved incident is taken up again only if something fires now.
    """
    severity = (F.when(F.col("anomaly_type_lower_higher").startswith("critical"), 2)
                .when(F.col("anomaly_type_lower_higher").startswith("warning"), 1).otherwise(0))
    first = F.struct("timestamp", *KEY, "anomaly_type_lower_higher",
                     *[name for name in ROW_COLUMNS if name != "timestamp"])
    details = F.struct("timestamp", *KEY, "description", "dq_dashboard_url", "text_inject")
    facts = rows.groupBy(*THREAD).agg(
        F.bool_or(firing()).alias("has_anomaly"),
        F.max(F.when(firing(), severity).otherwise(0)).alias("severity_rank"),
        F.min(F.when(firing(), first)).alias("first_fire"),
        F.min(details).alias("_details"),
        *bucket_counts(prefix="initial_"),
    )
    found = find_incidents(incidents, as_of).select(
        *THREAD, F.struct("slack_ts", "opened_at", "status", "summary_counts_json").alias("_incident"))
    state = threads.join(facts, THREAD, "left").join(found, THREAD, "left")
    fires = F.coalesce("has_anomaly", F.lit(False))
    usable = (F.col("_incident.status") == "open") | fires
    state = state.withColumns({
        "has_anomaly": fires,
        "severity": F.when(F.col("severity_rank") == 2, "critical").when(F.col("severity_rank") == 1, "warning")
        .otherwise(NORMAL),
        "reopened": F.coalesce((F.col("_incident.status") == "resolved") & fires, F.lit(False)),
        "_incident": F.when(usable, F.col("_incident")),
        **{f"initial_{bucket}": F.coalesce(f"initial_{bucket}", F.lit(0)) for bucket in BUCKETS},
    })
    opened = F.col("_incident.opened_at")
    return state.select(
        *[c for c in threads.columns], "has_anomaly", "severity", "reopened", "first_fire",
        F.col("_details.description").alias("description"),
        F.col("_details.dq_dashboard_url").alias("dq_dashboard_url"),
        F.col("_details.text_inject").alias("text_inject"),
        *[f"initial_{bucket}" for bucket in BUCKETS],
        F.col("_incident.slack_ts").alias("incident_slack_ts"), opened.alias("opened_at"),
        F.col("_incident.summary_counts_json").alias("summary_counts_json"),
        F.coalesce(opened <= timestamp_literal(as_of - HARD_CAP), F.lit(False)).alias("hard_cap"),
    )


def months_of_threads(state: DataFrame, as_of: datetime) -> DataFrame:
    """Months from the opening of the threads' incidents to the run: few, as threads past the cap are not in ``state``.

    An incident without a time of opening counts as opened when stamps begin to be sane.
    """
    start = F.date_trunc("month", F.coalesce("opened_at", timestamp_literal(SANE_FROM)))
    every = F.sequence(start, F.greatest(start, timestamp_literal(as_of)), F.expr("INTERVAL 1 MONTH"))
    spans = state.filter(F.col("incident_slack_ts").isNotNull()).select(every.alias("_months")).distinct()
    return spans.select(F.explode("_months").alias("_start")).select(F.date_format("_start", "yyyy-MM").alias("month")).distinct()


def key_states(state: DataFrame, rows: DataFrame, events: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Per thread, dimension and method: current and announced class, transition, projection.

    Threads past the cap are left out.  Announced keys that have no row any more
    keep their announced class.  With ``as_of`` and a log that is partitioned by the ``month`` of ``posted_at``, only months
    are read in which active incidents can have events: those from their opening to the run.
    """
    active = state.filter(~F.col("hard_cap"))
    current = rows.join(active.select(*THREAD), THREAD, "left_semi").select(
        *THREAD, *KEY, F.col("anomaly_type_lower_higher").alias("current"), *ROW_COLUMNS,
        F.lit(True).alias("has_row"))
    incidents = active.filter(F.col("incident_slack_ts").isNotNull()).select(*THREAD, "incident_slack_ts")
    if as_of is not None and "month" in events.columns:
        # one row per month; the comparison holds for all of them and tells the planner that pruning pays
        months = stored(months_of_threads(active, as_of), "active-months").filter(F.col("month") > "")
        events = events.join(F.broadcast(months), "month", "left_semi")
    # the log only grows; what is ranked are the events of active incidents
    log = events.join(incidents.select("incident_slack_ts"), "incident_slack_ts", "left_semi")
    announced = announced_states(log).join(incidents, "incident_slack_ts").select(*THREAD, *KEY, "announced", F.lit(True).alias("was_announced"))
    both = current.join(announced, [*THREAD, *KEY], "full_outer")
    now, before = firing("current"), firing("announced")
    seen = F.coalesce("has_row", F.lit(False))
    transition = (
        F.when(seen & now & ~before, F.lit(FIRE))
        .when(seen & now & (F.col("announced") != F.col("current")), F.lit(CHANGE))
        .when(seen & ~now & before, F.lit(RESOLVE))
    )
    projected = (F.when(F.col("transition").isin(FIRE, CHANGE), F.col("current"))
                 .when(F.col("transition") == RESOLVE, F.lit(NORMAL)).otherwise(F.col("announced")))
    return (both.withColumn("transition", transition)
            .withColumn("projected", projected)
            .withColumn("is_projected", F.coalesce("was_announced", F.lit(False)) | F.col("transition").isNotNull()))


def project_threads(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Thread state plus the counts after this run, and whether to summarise or close."""
    after = keys.groupBy(*THREAD).agg(
        F.count_if(F.col("transition").isNotNull()).alias("transitions"),
        F.count_if("is_projected").alias("projected_keys"),
        F.count_if(F.col("is_projected") & firing("projected")).alias("projected_firing"),
        *[F.count_if(F.col("is_projected") & (F.col("projected") == b)).alias(b) for b in BUCKETS],
    )
    joined = state.join(after, THREAD, "left").withColumns({
        name: F.coalesce(name, F.lit(0)) for name in ("transitions", "projected_keys", "projected_firing", *BUCKETS)})
    has_incident = F.col("incident_slack_ts").isNotNull()
    opens = ~F.col("hard_cap") & F.col("has_anomaly") & ~has_incident
    stored = F.from_json("summary_counts_json", COUNTS)
    initial = F.struct(*[F.col(f"initial_{b}").alias(b) for b in BUCKETS])
    posted = F.when(has_incident, stored).when(opens & (F.col("mode") == THREAD_MODE), initial)
    same = F.lit(True)
    for bucket in BUCKETS:
        same = same & F.coalesce(posted[bucket] == F.col(bucket), F.lit(False))
    return joined.withColumns({
        "opens": opens,
        "summarises": (F.col("transitions") > 0) & ~same,
        "closes": F.col("hard_cap") | (has_incident & (F.col("projected_keys") > 0)
                                       & (F.col("projected_firing") == 0)),
        "close_reason": F.when(F.col("hard_cap"), "hard_cap").otherwise("all_resolved"),
    })


def thread_identity(as_of: datetime) -> Column:
    """Id of a thread opened now; the same run gives the same id."""
    return F.md5(F.concat_ws("|", "config_name", F.col("anomaly_date").cast("string"), F.lit(as_of.isoformat())))


def message_identity(as_of: datetime) -> Column:
    """Id of one action of one run."""
    return F.md5(F.concat_ws("|", "incident_slack_ts", "dimension_split_value", "forecast_method", "kind",
                             F.lit(as_of.isoformat())))


ACTION_COLUMNS = [
    *THREAD, "kind", "phase", *KEY, "mode", "slack_channel_id", "incident_slack_ts", "severity",
    "anomaly_type_lower_higher", "previous_anomaly_type_lower_higher", *ROW_COLUMNS, *BUCKETS, "has_counts",
    "has_fire_card", "description", "dq_dashboard_url", "text_inject", "reason",
]


def list_actions(threads: DataFrame, keys: DataFrame, as_of: datetime) -> DataFrame:
    """Actions of all threads before the mode filter, as one table.

    ``threads`` comes from ``project_threads`` and carries ``mode`` and the channel.
    Within a thread, ``phase`` then dimension then method is the order of application.
    """
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    identity = F.coalesce("incident_slack_ts", thread_identity(as_of))
    blank = {
        "severity": text, "anomaly_type_lower_higher": text, "previous_anomaly_type_lower_higher": text,
        "timestamp": F.lit(None).cast("timestamp"), "forecast_value": F.lit(None).cast("double"),
        "actual_value": F.lit(None).cast("double"), "delta_rel": F.lit(None).cast("double"), "source_sql": text,
        **{b: number for b in BUCKETS}, "has_counts": F.lit(False), "has_fire_card": F.lit(False),
        "description": text, "dq_dashboard_url": text, "text_inject": text, "reason": text,
        "dimension_split_value": F.lit(""), "forecast_method": F.lit(""),
    }

    def actions(frame: DataFrame, kind: Column, **values: Column) -> DataFrame:
        filled = {**blank, **values, "kind": kind, "incident_slack_ts": identity}
        columns = {name: filled.get(name, F.col(name)) for name in ACTION_COLUMNS if name != "phase"}
        chosen = frame.select(*[column.alias(name) for name, column in columns.items()])
        phases = F.create_map(*[F.lit(item) for pair in PHASES.items() for item in pair])
        return chosen.withColumn("phase", F.element_at(phases, F.col("kind"))).select(*ACTION_COLUMNS)

    slim = F.col("mode") == THREAD_MODE
    card = F.when(~slim, F.col("first_fire"))
    opens = actions(
        threads.filter("opens"), F.lit(OPEN), severity=F.col("severity"), description=F.col("description"),
        dq_dashboard_url=F.col("dq_dashboard_url"), text_inject=F.col("text_inject"),
        has_counts=slim, has_fire_card=card.isNotNull(),
        **{b: F.when(slim, F.col(f"initial_{b}")).otherwise(F.lit(0)) for b in BUCKETS},
        anomaly_type_lower_higher=card["anomaly_type_lower_higher"],
        dimension_split_value=F.coalesce(card["dimension_split_value"], F.lit("")),
        forecast_method=F.coalesce(card["forecast_method"], F.lit("")),
        **{name: card[name] for name in ROW_COLUMNS},
    )
    per_thread = threads.select(*THREAD, "mode", "slack_channel_id", "incident_slack_ts")
    changed = keys.filter(F.col("transition").isNotNull()).join(per_thread, THREAD)
    shown = F.col("transition") != RESOLVE
    replies = actions(
        changed, F.col("transition"),
        dimension_split_value=F.col("dimension_split_value"), forecast_method=F.col("forecast_method"),
        anomaly_type_lower_higher=F.when(shown, F.col("current")).otherwise(F.lit(NORMAL)),
        previous_anomaly_type_lower_higher=F.when(F.col("transition") != FIRE, F.col("announced")),
        **{name: F.when(shown, F.col(name)) for name in ROW_COLUMNS},
    )
    summaries = actions(threads.filter("summarises"), F.lit(SUMMARY), has_counts=F.lit(True),
                        **{b: F.col(b) for b in BUCKETS})
    closures = actions(threads.filter("closes"), F.lit(CLOSE), reason=F.col("close_reason"))
    return opens.unionByName(replies).unionByName(summaries).unionByName(closures)


def is_visible() -> Column:
    """Whether a thread's mode shows this kind of action; unknown modes show all."""
    hidden = F.lit(False)
    for mode, kinds in VISIBLE.items():
        hidden = hidden | ((F.col("mode") == mode) & ~F.col("kind").isin(*kinds))
    return ~hidden


def in_order(actions: DataFrame) -> DataFrame:
    """Actions with ``action_seq``: from 1, by thread, then phase, then dimension and method.

    The sort splits the actions into ranges; places within a range are counted where it is, and only the sizes of the ranges,
    one row each, are brought together.  So a thread with very many keys is no single task's work.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = actions.orderBy(*THREAD, "phase", *KEY)
    placed = stored(ordered.withColumns({"_range": F.spark_partition_id(), "_place": within}), "in-order")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_range").withColumn(
        "action_seq", F.col("_start") + F.col("_place") + 1).drop("_range", "_place", "_start")
