"""Metric definitions and monitoring state over the star-schema and event tables.

The definitions stand for a user's YAML file, the threshold and channel rows
for the seed files.  Everything else is derived from the tables by Spark.
"""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewatch.config import MetricConfig
from tidewatch.operators.actuals import build_points, describe_source
from tidewatch.operators.deltas import NORMAL, build_deltas
from tidewatch.operators.forecast import forecast
from tidewatch.operators.threads import THREAD, bucket_counts, counts_json, dated, latest_per_key
from tidewatch.operators.versions import new_versions
from tidewatch.schemas import CHANNELS, DESCRIPTIONS, INCIDENTS, REPLY_EVENTS, THRESHOLDS
from tidewatch.session import stored

NOW = datetime(2024, 1, 30, 23, 59, 59)
ORDERS_NOW = datetime(2001, 8, 5)
SANE = (datetime(1992, 1, 1), datetime(2099, 12, 31))
ENVIRONMENT, REPORT, PAGE = "dev", "report-1", "page-1"
FIRST_DAY = "2024-01-01"

BY_TYPE, TOTAL, HOURLY, RATIO = (
    "events_by_type_daily", "events_total_daily", "events_value_hourly", "events_error_ratio_daily")


def _windows(**methods: float) -> dict:
    return {m: {"parameters": {"value": n} if m == "constant_value" else {"sliding_window": n}}
            for m, n in methods.items()}


def _metric(name: str, table: str, stamp: str, value: str, algorithms: dict, column: str = "", **more) -> MetricConfig:
    return MetricConfig(name=name, source_project="local", source_dataset="warehouse", source_table=table,
                        source_timestamp_column=stamp, source_timestamp_column_sql=stamp,
                        source_forecast_column=column or stamp, source_forecast_column_sql=value,
                        algorithms=algorithms, **more)


def event_configs(daily: int = 7, hourly: int = 72) -> list[MetricConfig]:
    """The monitored metrics; an earlier deployment used shorter windows."""
    day = _windows(mean=daily, median=daily)
    common = {"history_start": FIRST_DAY}
    return [
        _metric(BY_TYPE, "events", "ts", "COUNT(*)", {**day, **_windows(constant_value=60)}, "event_id",
                dimension_split="event_type", **common),
        _metric(TOTAL, "events", "ts", "COUNT(*)", day, "event_id", **common),
        _metric(HOURLY, "events", "ts", "SUM(value)", _windows(mean=hourly, median=hourly), "value",
                period_length="hour", forecast_start=FIRST_DAY, **common),
        _metric(RATIO, "events", "ts", "TRY_DIVIDE(COUNT_IF(event_type = 'error'), COUNT(*))", day, "event_type",
                **common),
    ]


def orders_config(name: str, value: str, algorithms: dict, column: str = "o_totalprice", **more) -> MetricConfig:
    return _metric(name, "orders", "o_orderdate", value, algorithms, column, history_start="1995-01-01", **more)


# (config, method, critical_lower, critical_higher, warning_lower, warning_higher)
THRESHOLD_ROWS = [
    (BY_TYPE, "median", -0.1, 0.1, -0.03, 0.03),
    (BY_TYPE, "mean", None, 0.3, -0.1, 0.1),
    (TOTAL, "median", -0.05, 0.05, -0.015, 0.015),
    (HOURLY, "median", -0.4, 0.4, -0.1, 0.1),
    (HOURLY, "mean", -0.5, 0.5, None, 0.2),
    (RATIO, "median", -0.1, 0.1, -0.03, 0.03),
]
# The earlier deployment, whose announcements the current run continues.
EARLIER_THRESHOLD_ROWS = [
    (BY_TYPE, "median", -0.12, 0.12, -0.04, 0.04),
    (BY_TYPE, "mean", -0.2, 0.2, -0.08, 0.08),
    (TOTAL, "median", -0.06, 0.06, -0.02, 0.02),
    (HOURLY, "median", -0.35, 0.35, -0.12, 0.12),
    (HOURLY, "mean", -0.4, 0.4, -0.2, 0.2),
]
DESCRIPTION_ROWS = [
    (BY_TYPE, "Events per day and type", "https://dq.example/events", None),
    (TOTAL, "Events per day", None, "<@oncall>"),
    (HOURLY, None, None, None),
]
CHANNEL_ROWS = [
    (BY_TYPE, "dev", "C-TYPES", "types", None),
    (None, "dev", "C-DEV", "dev", None),
    (None, "staging", "C-STAGING", "staging", None),
    (TOTAL, "prod", "C-PROD-TOTAL", "totals", None),
]
PRODUCTS = T.StructType([T.StructField("config_name", T.StringType()), T.StructField("product", T.StringType())])
PRODUCT_ROWS = [(BY_TYPE, "events"), (TOTAL, "events"), (HOURLY, "value")]


def small(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A handful of literal rows; through Arrow, so that the plan knows how few they are."""
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, to_arrow_schema(schema))],
        schema=to_arrow_schema(schema)))


def thresholds(spark: SparkSession) -> DataFrame:
    return small(spark, THRESHOLD_ROWS, THRESHOLDS)


def descriptions(spark: SparkSession) -> DataFrame:
    return small(spark, DESCRIPTION_ROWS, DESCRIPTIONS)


def channels(spark: SparkSession) -> DataFrame:
    return small(spark, CHANNEL_ROWS, CHANNELS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Monitoring:
    """The stored tables of one deployment: each is computed once and written.

    Kept per session and source folder, as the tables of a deployment are;
    what is not asked for is not computed.
    """

    _known: dict[tuple[str, str], Monitoring] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self.alerting: str | None = None  # where written alert runs are, once there are any
        self.ingested: str | None = None  # the same for ingest runs

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Monitoring:
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._known:
            cls._known[key] = cls(spark, folder)
        return cls._known[key]

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = stored(build(), name)
        return self._tables[name]

    def points(self) -> DataFrame:
        return self._once("points", lambda: build_points(
            self.spark, event_configs(), lambda cfg: table(self.spark, self.folder, cfg.source_table), NOW))

    def forecasts(self, configs: list[MetricConfig], points: DataFrame) -> DataFrame:
        return forecast(points, configs, NOW)

    def _deltas(self, configs: list[MetricConfig], points: DataFrame, limits: DataFrame) -> DataFrame:
        actuals = new_versions(describe_source(points, configs), NOW)
        predicted = new_versions(describe_source(self.forecasts(configs, points), configs), NOW)
        return build_deltas(actuals, predicted, limits, descriptions(self.spark), NOW, fine_grained=False)

    def deltas(self) -> DataFrame:
        return self._once("deltas", lambda: self._deltas(event_configs(), self.points(), thresholds(self.spark)))

    def earlier_rows(self) -> DataFrame:
        """Newest anomalous row per key as the earlier deployment saw it."""
        def build() -> DataFrame:
            configs = event_configs(daily=3, hourly=24)[:3]
            points = self.points().filter(F.col("config_name") != RATIO)
            rows = self._deltas(configs, points, small(self.spark, EARLIER_THRESHOLD_ROWS, THRESHOLDS))
            newest = latest_per_key(dated(rows).filter(F.col("forecast_method").isNotNull()))
            return newest.filter(F.col("anomaly_type") != NORMAL).select(
                *THREAD, "dimension_split_value", "forecast_method", "timestamp", "delta_rel",
                "anomaly_type_lower_higher")
        return self._once("earlier", build)

    def incidents(self) -> DataFrame:
        return self._once("incidents", lambda: incident_history(self.earlier_rows()))

    def events(self) -> DataFrame:
        return self._once("events", lambda: event_history(self.earlier_rows(), self.incidents()))


def _after(stamp, text: str):
    return stamp + F.expr(f"INTERVAL {text}")


def incident_history(rows: DataFrame) -> DataFrame:
    """The incident log the earlier deployment left behind.

    The first week was suppressed; threads without critical keys were resolved
    after 28 hours; threads with several critical keys had an older incident.
    """
    threads = rows.groupBy(*THREAD).agg(*bucket_counts()).withColumns({
        "_critical": F.col("critical_higher") + F.col("critical_lower"),
        "_warning": F.col("warning_higher") + F.col("warning_lower"),
        "_day": F.col("anomaly_date").cast("timestamp"),
        "_name": F.concat_ws("-", "config_name", F.col("anomaly_date").cast("string")),
        "_marker": F.col("anomaly_date") < F.lit("2024-01-08").cast("date"),
    })
    resolved = F.col("_marker") | (F.col("_critical") == 0)
    opened = _after(F.col("_day"), "20 HOURS")
    main = threads.select(
        *THREAD, F.lit("C-LOG").alias("slack_channel_id"),
        F.when(F.col("_marker"), F.concat(F.lit("BOOTSTRAP-"), "_name", F.lit("-00000000")))
        .otherwise(F.concat(F.lit("T-"), "_name")).alias("slack_ts"),
        opened.alias("opened_at"),
        F.when(F.col("_marker"), opened).when(resolved, _after(opened, "28 HOURS")).alias("closed_at"),
        F.when(resolved, "resolved").otherwise("open").alias("status"),
        F.md5(F.concat(F.lit("T-"), "_name")).alias("client_msg_id"),
        F.when(F.col("_warning") == 1, "corrupt").otherwise(counts_json()).alias("summary_counts_json"))
    older = threads.filter(~F.col("_marker") & (F.col("_critical") >= 2)).select(
        *THREAD, F.lit("C-LOG").alias("slack_channel_id"), F.concat(F.lit("E-"), "_name").alias("slack_ts"),
        _after(F.col("_day"), "10 HOURS").alias("opened_at"), _after(F.col("_day"), "14 HOURS").alias("closed_at"),
        F.lit("resolved").alias("status"), F.md5(F.concat(F.lit("E-"), "_name")).alias("client_msg_id"),
        counts_json().alias("summary_counts_json"))
    return main.unionByName(older).select(*INCIDENTS.names)


def event_history(rows: DataFrame, incidents: DataFrame) -> DataFrame:
    """The reply log: a fire per key, some escalations, resolutions and simultaneous posts."""
    real = incidents.filter(F.col("slack_ts").startswith("T-")).select(*THREAD, "slack_ts", "opened_at")
    keys = rows.join(real, THREAD)
    kind = F.col("anomaly_type_lower_higher")

    def log(frame: DataFrame, label: str, event: str, state, previous, later: str) -> DataFrame:
        identity = F.md5(F.concat_ws("|", F.lit(label), "slack_ts", "dimension_split_value", "forecast_method"))
        return frame.select(
            F.col("slack_ts").alias("incident_slack_ts"), "config_name", "dimension_split_value", "forecast_method",
            identity.alias("slack_ts"), F.lit("C-LOG").alias("slack_channel_id"), F.lit(event).alias("kind"),
            state.alias("anomaly_type_lower_higher"), previous.alias("previous_anomaly_type_lower_higher"),
            F.col("timestamp").alias("anomaly_timestamp"), _after(F.col("opened_at"), later).alias("posted_at"),
            identity.alias("client_msg_id")).select(*REPLY_EVENTS.names)

    none = F.lit(None).cast("string")
    fires = log(keys, "fire", "fire", kind, none, "0 HOURS")
    worse = log(keys.filter((F.col("forecast_method") == "mean") & kind.startswith("warning")), "worse",
                "severity_change", F.replace(kind, F.lit("warning"), F.lit("critical")), kind, "1 HOUR")
    over = log(keys.filter((F.col("forecast_method") == "median") & (kind == "warning_lower")), "over", "resolve",
               F.lit("normal"), kind, "1 HOUR")
    tie = log(keys.filter(kind == "critical_higher"), "tie", "severity_change", F.lit("critical_lower"), kind,
              "0 HOURS")
    summaries = log(
        real.withColumns({"dimension_split_value": none, "forecast_method": none,
                          "timestamp": F.lit(None).cast("timestamp")}),
        "summary", "summary", none, none, "3 HOURS")
    return fires.unionByName(worse).unionByName(over).unionByName(tie).unionByName(summaries)
