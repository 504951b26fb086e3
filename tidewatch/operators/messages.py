"""Message text of actions, as column expressions over the actions table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.text import ascii_json, instant_text, number_text, percent_encoded
from tidewatch.operators.deltas import BUCKETS
from tidewatch.operators.transitions import CHANGE, CLOSE, FIRE, OPEN, RESOLVE, SUMMARY

# Address, parameter and filter slots of the dashboard, and the text layout below.
REPORT_ADDRESS = "https://datastudio.google.com/u/0/reporting/"
FILTER_SEPARATOR = "%EE%80%80"
CONFIG_FILTER, DIMENSION_FILTER = "df34", "df43"
RED, YELLOW, GREEN, UNKNOWN = ":red_circle:", ":large_yellow_circle:", ":large_green_circle:", ":grey_question:"
NO_DESCRIPTION = "No description available"


def dashboard_link(report: str, page: str, config: Column, method: Column, dimension: Column) -> Column:
    """Link that opens the dashboard filtered to a config and dimension; empty ones set no filter."""
    def only(value: Column) -> Column:
        lead = FILTER_SEPARATOR.join(["include", "0", "IN", ""])
        return F.when(value != "", F.concat(F.lit(lead), value))

    parameters = F.to_json(F.struct(
        config.alias("PARAM_CONFIG_NAME"), method.alias("PARAM_FC"), dimension.alias("PARAM_DIMENSION"),
        only(config).alias(CONFIG_FILTER), only(dimension).alias(DIMENSION_FILTER)))
    return F.concat(F.lit(f"{REPORT_ADDRESS}{report}/page/{page}?params="), percent_encoded(ascii_json(parameters)))


def _circle(kind: Column) -> Column:
    return (F.when(kind.startswith("critical"), RED).when(kind.startswith("warning"), YELLOW)
            .when(kind == "normal", GREEN).otherwise(UNKNOWN))


def _optional(condition: Column, *parts: Column | str) -> Column:
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.when(F.coalesce(condition, F.lit(False)), text).otherwise("")


def _trimmed(column: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"^\s+|\s+$", "")


def counts_table() -> Column:
    """Fixed-width table of the four bucket counts."""
    def cell(bucket: str, width: int) -> Column:
        text = F.col(bucket).cast("string")
        return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))

    return F.concat(
        F.lit("```\n          | higher | lower |\n critical | "), cell("critical_higher", 6), F.lit(" | "),
        cell("critical_lower", 5), F.lit(" |\n warning  | "), cell("warning_higher", 6), F.lit(" | "),
        cell("warning_lower", 5), F.lit(" |\n```"))


def _total() -> Column:
    total = F.lit(0)
    for bucket in BUCKETS:
        total = total + F.coalesce(F.col(bucket), F.lit(0))
    return total


def fire_card(link: Column) -> Column:
    dimension, query = F.col("dimension_split_value"), F.coalesce("source_sql", F.lit(""))
    return F.concat(
        _optional(dimension != "", "*Dimension*: `", dimension, "`\n"),
        F.lit("*Method*: "), F.col("forecast_method"),
        F.lit("\n*Timestamp*: "), instant_text(F.col("timestamp")),
        F.lit("\n*Forecast*: "), number_text(F.col("forecast_value")),
        F.lit("\n*Actual*: "), number_text(F.col("actual_value")),
        F.lit("\n*Relative delta*: "), number_text(F.col("delta_rel")),
        F.lit("\n*Dashboard*: <"), link, F.lit("|drill in>"),
        _optional(query != "", "\n*Query*:\n```\nSELECT", query, "\n```"),
    )


def opener(environment: str, link: Column) -> Column:
    described = F.when(F.coalesce("description", F.lit("")) == "", NO_DESCRIPTION).otherwise(F.col("description"))
    board, inject = _trimmed("dq_dashboard_url"), _trimmed("text_inject")
    kind = F.coalesce("anomaly_type_lower_higher", F.lit("normal"))
    severity = (F.when(F.col("severity") == "critical", RED).when(F.col("severity") == "warning", YELLOW)
                .otherwise(GREEN))
    head = F.concat(
        severity, F.lit(" *Incident*: `"), F.col("config_name"),
        F.lit("`\n*Data date*: `"), F.col("anomaly_date").cast("string"),
        F.lit("`\n*Dashboard*: <"), link, F.lit("|Anomaly Detection>"),
        _optional(board != "", "\n*DQ dashboard*: <", board, "|open>"),
        F.lit("" if environment == "prod" else f"\n*Environment*: {environment}"),
        F.lit("\n_"), described, F.lit("_"))
    body = (F.when(F.col("has_fire_card"), F.concat(F.lit("\n*Anomaly*: "), kind, F.lit("\n"), fire_card(link)))
            .when(F.col("has_counts") & (_total() > 0),
                  F.concat(F.lit("\n*State* ("), _total().cast("string"), F.lit(" active):\n"), counts_table()))
            .otherwise(""))
    return F.concat(head, body, _optional(inject != "", "\n\n", inject))


def severity_change(link: Column) -> Column:
    dimension, before = F.col("dimension_split_value"), F.col("previous_anomaly_type_lower_higher")
    now = F.col("anomaly_type_lower_higher")
    return F.concat(
        _circle(before), F.lit("→"), _circle(now), F.lit(" *Severity change*"),
        _optional(dimension != "", " `", dimension, "`"), F.lit(": "), before, F.lit(" → *"), now,
        F.lit("*\n*Timestamp*: "), instant_text(F.col("timestamp")),
        F.lit("\n*Forecast*: "), number_text(F.col("forecast_value")),
        F.lit(", *Actual*: "), number_text(F.col("actual_value")),
        F.lit(", *Relative delta*: "), number_text(F.col("delta_rel")),
        F.lit("\n*Dashboard*: <"), link, F.lit("|drill in>"))


def message_text(environment: str, report: str, page: str) -> Column:
    link = dashboard_link(report, page, F.col("config_name"), F.col("forecast_method"), F.col("dimension_split_value"))
    kind, dimension = F.col("kind"), F.col("dimension_split_value")
    now = F.col("anomaly_type_lower_higher")
    return (
        F.when(kind == OPEN, opener(environment, link))
        .when(kind == FIRE, F.concat(_circle(now), F.lit(" *New*: "), now, F.lit("\n"), fire_card(link)))
        .when(kind == CHANGE, severity_change(link))
        .when(kind == RESOLVE, F.concat(F.lit(f"{GREEN} *Resolved*"), _optional(dimension != "", " `", dimension, "`"),
                                        F.lit(" (was "), F.col("previous_anomaly_type_lower_higher"), F.lit(")")))
        .when(kind == SUMMARY, F.concat(F.lit(":bar_chart: *Summary* ("), _total().cast("string"),
                                        F.lit(" active)\n"), counts_table()))
        .when(kind == CLOSE, F.concat(F.lit(":white_check_mark: *Incident closed* ("), F.col("reason"), F.lit(")")))
    )


def outbox(actions: DataFrame, environment: str, report: str, page: str) -> DataFrame:
    """Messages to deliver, in the order phase, dimension, method within a thread.

    Delivery is left to the consumer of this table.  ``action_seq`` is passed on where the actions have it.
    """
    numbered = ["action_seq"] if "action_seq" in actions.columns else []
    return actions.select(
        *numbered, "config_name", "anomaly_date", "slack_channel_id", F.col("incident_slack_ts").alias("thread_id"),
        (F.col("kind") == OPEN).alias("is_parent"), "kind", "phase", "dimension_split_value", "forecast_method",
        message_text(environment, report, page).alias("text"))
