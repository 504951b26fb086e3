"""Schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def schema_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STRING, _DOUBLE, _TIMESTAMP = T.StringType(), T.DoubleType(), T.TimestampType()

ACTUALS = schema_of(
    key=_STRING, source_project=_STRING, source_dataset=_STRING, source_table=_STRING,
    source_timestamp_column=_STRING, source_timestamp_column_sql=_STRING,
    source_forecast_column=_STRING, source_forecast_column_sql=_STRING,
    source_sql=_STRING, source_sql_hash=_STRING, period_length=_STRING,
    timestamp=_TIMESTAMP, value=_DOUBLE, valid_from=_TIMESTAMP, valid_to=_TIMESTAMP,
    config_name=_STRING, dimension_split=_STRING, dimension_split_value=_STRING,
    is_latest=T.BooleanType(),
)

FORECASTS = T.StructType([*ACTUALS.fields[:11], T.StructField("forecast_method", _STRING), *ACTUALS.fields[11:]])

# Beside the stored deltas: last class of each series and month, what they were built with, months that wait.
DELTAS_ENDS = schema_of(config_name=_STRING, _method=_STRING, _dimension=_STRING, _span=_TIMESTAMP, _end=_STRING)
DELTAS_STATE = schema_of(config_name=_STRING, newest=_TIMESTAMP, settings=_STRING)
DELTAS_PENDING = schema_of(config_name=_STRING, waiting=_STRING)

THRESHOLDS = schema_of(
    config_name=_STRING, forecast_method=_STRING,
    critical_lower=_DOUBLE, critical_higher=_DOUBLE, warning_lower=_DOUBLE, warning_higher=_DOUBLE,
)

DESCRIPTIONS = schema_of(config_name=_STRING, description=_STRING, dq_dashboard_url=_STRING, text_inject=_STRING)

CHANNELS = schema_of(
    config_name=_STRING, environment=_STRING, slack_channel_id=_STRING,
    slack_channel_name=_STRING, thread_timeout_hours=_STRING,
)

INCIDENTS = schema_of(
    config_name=_STRING, anomaly_date=T.DateType(), slack_channel_id=_STRING, slack_ts=_STRING,
    opened_at=_TIMESTAMP, closed_at=_TIMESTAMP, status=_STRING, client_msg_id=_STRING,
    summary_counts_json=_STRING,
)

REPLY_EVENTS = schema_of(
    incident_slack_ts=_STRING, config_name=_STRING, dimension_split_value=_STRING, forecast_method=_STRING,
    slack_ts=_STRING, slack_channel_id=_STRING, kind=_STRING, anomaly_type_lower_higher=_STRING,
    previous_anomaly_type_lower_higher=_STRING, anomaly_timestamp=_TIMESTAMP, posted_at=_TIMESTAMP,
    client_msg_id=_STRING,
)

OUTBOX = schema_of(
    decided_at=_TIMESTAMP, action_seq=T.LongType(), config_name=_STRING, anomaly_date=T.DateType(),
    slack_channel_id=_STRING, thread_id=_STRING, is_parent=T.BooleanType(), kind=_STRING, phase=T.IntegerType(),
    dimension_split_value=_STRING, forecast_method=_STRING, text=_STRING,
)

DEDUP_INDEX = schema_of(event_hash=_STRING, processed_at=_TIMESTAMP, rendered_message=_STRING)

REPLAY_ROWS = schema_of(
    config_name=_STRING, timestamp=_TIMESTAMP, anomaly_date=T.DateType(), dimension_split_value=_STRING,
    forecast_method=_STRING, anomaly_type_lower_higher=_STRING, forecast_value=_DOUBLE, actual_value=_DOUBLE,
    delta_rel=_DOUBLE, description=_STRING, dq_dashboard_url=_STRING, text_inject=_STRING, source_sql=_STRING,
)

PUBLICATIONS = schema_of(
    dataset=_STRING, environment=_STRING, date=T.DateType(), timestamp=_TIMESTAMP, date_interval=_STRING,
    first_valid_from_date=T.DateType(), timestamp_delay_hour=_DOUBLE,
    timestamp_delay_now_hypothetical_vs_expected_delay_hour=_DOUBLE,
)
