"""Which incident threads a run looks at, and the incident each belongs to.

A thread is a ``(config_name, anomaly_date)`` pair.  All steps work on sets of
threads at once; the number of rows in one thread is never assumed small, so
threads are aggregated and joined, not gathered.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.periods import timestamp_literal
from tidewatch.operators.deltas import BUCKETS, NORMAL

THREAD = ["config_name", "anomaly_date"]
KEY = ["dimension_split_value", "forecast_method"]
# How long a thread lives, may be reopened, and is looked back for.
HARD_CAP = timedelta(hours=168)
REOPEN = timedelta(hours=24)
LOOKBACK = timedelta(hours=30 * 24)
# Fixed value: start of the thread id of suppressed history.
BOOTSTRAP = "BOOTSTRAP-"


def is_bootstrap() -> Column:
    return F.coalesce(F.col("slack_ts"), F.lit("")).startswith(BOOTSTRAP)


def dated(deltas: DataFrame) -> DataFrame:
    """Rows with their thread date and a dimension that is never NULL."""
    return deltas.withColumns({
        "anomaly_date": F.to_date("timestamp"),
        "dimension_split_value": F.coalesce("dimension_split_value", F.lit("")),
    })


def latest_per_key(rows: DataFrame) -> DataFrame:
    """The newest row of every thread, dimension and method (tie: larger delta last)."""
    newest = Window.partitionBy(*THREAD, *KEY).orderBy(F.desc("timestamp"), F.asc("delta_rel"))
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def keys_of_interest(deltas: DataFrame, incidents: DataFrame, as_of: datetime) -> DataFrame:
    """Keys anomalous in the lookback, or at any time of its days on the day of an open incident.

    Only rows of the lookback are alerted on, so days before its first one are not read.
    """
    first_day = (as_of - LOOKBACK).replace(hour=0, minute=0, second=0, microsecond=0)
    odd = dated(deltas.filter(F.col("timestamp") >= timestamp_literal(first_day))).filter(
        F.col("anomaly_type") != NORMAL).select(*THREAD, *KEY, "timestamp")
    recent = odd.filter(F.col("timestamp") >= timestamp_literal(as_of - LOOKBACK)).select(*THREAD, *KEY)
    open_threads = incidents.filter(F.col("status") == "open").select(*THREAD).distinct()
    watched = odd.join(open_threads, THREAD, "left_semi").select(*THREAD, *KEY)
    return recent.union(watched).distinct()


def rows_of_interest(deltas: DataFrame, incidents: DataFrame, as_of: datetime) -> DataFrame:
    """Newest recent row of every key of interest, also when it is normal again.

    A row without a method has no forecast and equals no key, so it never alerts.
    """
    recent = dated(deltas).filter(F.col("timestamp") >= timestamp_literal(as_of - LOOKBACK))
    wanted = keys_of_interest(deltas, incidents, as_of)
    return latest_per_key(recent.join(wanted, [*THREAD, *KEY], "left_semi"))


def bootstrapped_threads(incidents: DataFrame) -> DataFrame:
    return incidents.filter(is_bootstrap()).select(*THREAD).distinct()


def silenced_threads(incidents: DataFrame, as_of: datetime, cap: timedelta = HARD_CAP) -> DataFrame:
    """Threads whose newest real incident is resolved and was opened before the cap."""
    newest = Window.partitionBy(*THREAD).orderBy(F.desc("opened_at"), F.asc("slack_ts"))
    last = (incidents.filter(~is_bootstrap()).withColumn("_rank", F.row_number().over(newest))
            .filter("_rank = 1"))
    done = (F.col("status") == "resolved") & (F.col("opened_at") <= timestamp_literal(as_of - cap))
    return last.filter(done).select(*THREAD)


def without_suppressed(rows: DataFrame, incidents: DataFrame, as_of: datetime) -> DataFrame:
    """Drop rows without a date and rows of suppressed threads."""
    suppressed = bootstrapped_threads(incidents).union(silenced_threads(incidents, as_of)).distinct()
    return rows.filter(F.col("anomaly_date").isNotNull()).join(suppressed, THREAD, "left_anti")


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rows that cannot be assigned to a thread."""
    return rows.filter(F.col("anomaly_date").isNull())


def first_seen_configs(rows: DataFrame, incidents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Configs with rows but without any incident so far.

    ``known`` names configs with incidents, for callers whose ``incidents`` are not all there ever were.
    """
    names = incidents.select("config_name")
    known = (names if known is None else names.union(known.select("config_name"))).filter("config_name IS NOT NULL").distinct()
    return rows.select("config_name").distinct().join(known, "config_name", "left_anti")


def counts_json(prefix: str = "") -> Column:
    """Bucket counts as JSON text with the spacing the stored tables use."""
    template = "{" + ", ".join(f'"{bucket}": %d' for bucket in BUCKETS) + "}"
    return F.format_string(template, *[F.col(f"{prefix}{bucket}") for bucket in BUCKETS])


def bucket_counts(column: str = "anomaly_type_lower_higher", prefix: str = "") -> list[Column]:
    return [F.count_if(F.col(column) == bucket).alias(f"{prefix}{bucket}") for bucket in BUCKETS]


def bootstrap_incidents(rows: DataFrame, incidents: DataFrame, as_of: datetime, known: DataFrame | None = None) -> DataFrame:
    """Resolved marker incidents for the history of first-seen configs (before today)."""
    fresh = first_seen_configs(rows, incidents, known)
    past = rows.filter(F.col("anomaly_date") < F.lit(as_of.date())).join(fresh, "config_name", "left_semi")
    counted = past.groupBy(*THREAD).agg(*bucket_counts())
    identity = F.md5(F.concat_ws("|", F.lit("bootstrap"), "config_name", F.col("anomaly_date").cast("string"),
                                 F.lit(as_of.isoformat())))
    now = timestamp_literal(as_of)
    return counted.select(
        *THREAD, F.lit("").alias("slack_channel_id"),
        F.concat(F.lit(BOOTSTRAP), "config_name", F.lit("-"), F.col("anomaly_date").cast("string"), F.lit("-"),
                 F.substring(identity, 1, 8)).alias("slack_ts"),
        now.alias("opened_at"), now.alias("closed_at"), F.lit("resolved").alias("status"),
        identity.alias("client_msg_id"), counts_json().alias("summary_counts_json"),
    )


def find_incidents(incidents: DataFrame, as_of: datetime) -> DataFrame:
    """One incident per thread: an open one, else one resolved in the last day."""
    recent = (F.col("status") == "resolved") & (F.col("closed_at") >= timestamp_literal(as_of - REOPEN))
    usable = incidents.filter((F.col("status") == "open") | recent)
    best = Window.partitionBy(*THREAD).orderBy(
        F.when(F.col("status") == "open", 0).otherwise(1), F.desc("opened_at"), F.asc("slack_ts"))
    return usable.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def live_months(incidents: DataFrame, as_of: datetime) -> DataFrame:
    """Months of ``opened_at`` that a later run has to read however old they are.

    They hold the incidents of threads with an open one, the later ones of these threads too; a thread that is silenced by now
    stays so.  Incidents of other threads matter while their date is in the lookback, so in months a run reads anyway.
    """
    opened = incidents.filter(F.col("status") == "open").select(*THREAD).distinct()
    watched = opened.join(silenced_threads(incidents, as_of), THREAD, "left_anti")
    stamps = incidents.filter(F.col("opened_at").isNotNull()).join(watched, THREAD, "left_semi")
    return stamps.select(F.date_format("opened_at", "yyyy-MM").alias("month")).distinct()


def route_channels(threads: DataFrame, channels: DataFrame, environment: str) -> DataFrame:
    """Add the channel: the config's own in this environment, else the environment's.

    ``slack_channel_id`` is NULL where neither exists; such threads are skipped.
    """
    names = ["slack_channel_id", "slack_channel_name"]
    here = channels.filter(F.col("environment") == environment)
    own = (here.filter(F.col("config_name").isNotNull()).groupBy("config_name")
           .agg(F.min(F.struct(*names)).alias("_own")))
    # Grouped by the one environment that is left: a single row, so the broadcast is bounded.
    shared = (here.filter(F.col("config_name").isNull()).groupBy(F.col("environment").alias("_environment"))
              .agg(F.min(F.struct(*names)).alias("_shared")))
    found = (threads.withColumn("_environment", F.lit(environment)).join(own, "config_name", "left")
             .join(F.broadcast(shared), "_environment", "left"))
    chosen = F.coalesce("_own", "_shared")
    return found.withColumns({name: chosen[name] for name in names}).drop("_own", "_shared", "_environment")


def threads_to_visit(rows: DataFrame, incidents: DataFrame, as_of: datetime, open_too: bool = True) -> DataFrame:
    """Threads with rows and threads with an open incident, minus silenced ones."""
    threads = rows.select(*THREAD).distinct()
    if open_too:
        opened = incidents.filter(F.col("status") == "open").select(*THREAD).distinct()
        opened = opened.join(silenced_threads(incidents, as_of), THREAD, "left_anti")
        threads = threads.union(opened).distinct()
    return threads
