import json
from datetime import date, datetime
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F, types as T

from tidewatch.functions import text
from tidewatch.operators import messages as m
from tidewatch.operators.deltas import BUCKETS
from tidewatch.operators.transitions import CHANGE, CLOSE, FIRE, OPEN, RESOLVE, SUMMARY

LINK_CASES = [("lineitem_discounts", "constant_value", "AIR REG"), ("orders_total", "max", "1-URGENT")]


def expected_link(config, method, dimension):
    """The link by the standard library: JSON without blanks, percent-encoded but for colons and commas."""
    separator = quote(chr(0xE000))
    values = {"PARAM_CONFIG_NAME": config, "PARAM_FC": method, "PARAM_DIMENSION": dimension}
    values |= {slot: separator.join(["include", "0", "IN", value]) for slot, value in (("df34", config), ("df43", dimension))}
    return f"{m.REPORT_ADDRESS}rep/page/p_1?params=" + quote(json.dumps(values, separators=(",", ":")), safe=":,")


ACTION = T.StructType([T.StructField(n, t) for n, t in [
    ("config_name", T.StringType()), ("anomaly_date", T.DateType()), ("kind", T.StringType()),
    ("severity", T.StringType()), ("dimension_split_value", T.StringType()), ("forecast_method", T.StringType()),
    ("anomaly_type_lower_higher", T.StringType()), ("previous_anomaly_type_lower_higher", T.StringType()),
    ("timestamp", T.TimestampType()), ("forecast_value", T.DoubleType()), ("actual_value", T.DoubleType()),
    ("delta_rel", T.DoubleType()), ("source_sql", T.StringType()), ("has_counts", T.BooleanType()),
    ("has_fire_card", T.BooleanType()), ("description", T.StringType()), ("dq_dashboard_url", T.StringType()),
    ("text_inject", T.StringType()), ("reason", T.StringType()), *[(b, T.LongType()) for b in BUCKETS]]])
BLANK = {"config_name": "freight_weight", "anomaly_date": date(2031, 9, 17), "severity": "critical", "dimension_split_value": "harbour",
         "forecast_method": "median", "anomaly_type_lower_higher": "critical_higher", "timestamp": datetime(2031, 9, 17),
         "forecast_value": 40.0, "actual_value": 52.0, "delta_rel": 0.3, "has_counts": False, "has_fire_card": False}


@pytest.fixture(scope="module")
def render(spark):
    def run(environment="dev", **values):
        row = {**BLANK, **values}
        frame = spark.createDataFrame([tuple(row.get(name) for name in ACTION.names)], ACTION)
        return frame.select(m.message_text(environment, "rep", "p_1")).first()[0]
    return run


def link(spark, *parts):
    frame = spark.createDataFrame([parts], "c string, m string, d string")
    return frame.select(m.dashboard_link("rep", "p_1", F.col("c"), F.col("m"), F.col("d"))).first()[0]


def test_link(spark):
    for case in LINK_CASES:
        assert link(spark, *case) == expected_link(*case)
    bare = link(spark, "", "mean", "")
    assert "df34" not in bare and "df43" not in bare and "PARAM_DIMENSION" in bare
    odd = link(spark, "a b*c~", "m", 'é"\\😀')
    assert "a%20b%2Ac~" in odd and "+" not in odd
    assert "%5Cu00e9%5C%22%5C%5C%5Cud83d%5Cude00" in odd


def test_opener_with_counts(render, spark):
    got = render(kind=OPEN, has_counts=True, critical_higher=2, critical_lower=0, warning_higher=1, warning_lower=0,
                 dimension_split_value="", forecast_method="", description="about", text_inject=" <@me> ",
                 dq_dashboard_url=" https://dq.example/x ")
    assert got == (
        ":red_circle: *Incident*: `freight_weight`\n*Data date*: `2031-09-17`\n"
        f"*Dashboard*: <{link(spark, 'freight_weight', '', '')}|Anomaly Detection>\n*DQ dashboard*: <https://dq.example/x|open>\n"
        "*Environment*: dev\n_about_\n*State* (3 active):\n"
        "```\n          | higher | lower |\n critical |      2 |     0 |\n warning  |      1 |     0 |\n```\n\n<@me>")


def test_slim_opener(render):
    got = render("prod", kind=OPEN, severity="warning", has_counts=True, dq_dashboard_url="   ", text_inject=" ",
                 **{b: 0 for b in BUCKETS})
    assert got.startswith(":large_yellow_circle: *Incident*") and got.endswith("\n_No description available_")
    assert "Environment" not in got and "DQ dashboard" not in got and "*State*" not in got


def test_opener_with_fire_card(render, spark):
    got = render(kind=OPEN, has_fire_card=True, source_sql=" x FROM t", text_inject="ping")
    card = (f"*Dimension*: `harbour`\n*Method*: median\n*Timestamp*: 2031-09-17 00:00:00+00:00\n*Forecast*: 40.0\n*Actual*: 52.0\n"
            f"*Relative delta*: 0.3\n*Dashboard*: <{link(spark, 'freight_weight', 'median', 'harbour')}|drill in>\n"
            "*Query*:\n```\nSELECT x FROM t\n```")
    assert got.endswith(f"\n*Anomaly*: critical_higher\n{card}\n\nping")


def test_replies(render, spark):
    assert render(kind=FIRE, dimension_split_value="", delta_rel=None).startswith(
        ":red_circle: *New*: critical_higher\n*Method*: median\n")
    assert render(kind=CHANGE, previous_anomaly_type_lower_higher="warning_lower") == (
        ":large_yellow_circle:→:red_circle: *Severity change* `harbour`: warning_lower → *critical_higher*\n"
        "*Timestamp*: 2031-09-17 00:00:00+00:00\n*Forecast*: 40.0, *Actual*: 52.0, *Relative delta*: 0.3\n"
        f"*Dashboard*: <{link(spark, 'freight_weight', 'median', 'harbour')}|drill in>")
    assert render(kind=RESOLVE, previous_anomaly_type_lower_higher="critical_higher") == (
        ":large_green_circle: *Resolved* `harbour` (was critical_higher)")
    assert render(kind=RESOLVE, dimension_split_value="", previous_anomaly_type_lower_higher="x") == (
        ":large_green_circle: *Resolved* (was x)")
    assert render(kind=CLOSE, reason="hard_cap") == ":white_check_mark: *Incident closed* (hard_cap)"


def test_wide_counts_keep_all_digits(render):
    got = render(kind=SUMMARY, critical_higher=12345678, critical_lower=0, warning_higher=0, warning_lower=1234567)
    assert got.startswith(":bar_chart: *Summary* (13580245 active)\n```")
    assert "| 12345678 |     0 |" in got and "|      0 | 1234567 |" in got


def test_numbers_are_written_as_python_writes_them(spark):
    values = [0.0, 1.0, 2.5, -0.15, 1e-6, 2.3e-5, 4e-5, 1e-4, 0.123456, 1234567.5, 12345678901.25, 1e15, 1e16, 2.5e20, -3e-6]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in frame.select(text.number_text(F.col("v"))).collect()] == [repr(v) for v in values]
    assert spark.range(1).select(text.number_text(F.lit(None).cast("double"))).first()[0] == "None"


def test_hashed_values_are_written_as_python_writes_them(spark):
    strings = ["plain", "it's", 'both \' and "', "back\\slash", None]
    frame = spark.createDataFrame([(v,) for v in strings], "v string")
    assert [r[0] for r in frame.select(text.quoted_text(F.col("v"))).collect()] == [repr(v) for v in strings]
    stamps = [datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 600)]
    frame = spark.createDataFrame([(v,) for v in stamps], "v timestamp")
    assert [r[0] for r in frame.select(text.instant_literal_text(F.col("v"))).collect()] == [
        repr(v)[:-1] + ", tzinfo=datetime.timezone.utc)" for v in stamps]
    assert [r[0] for r in frame.select(text.instant_text(F.col("v"))).collect()] == [f"{v}+00:00" for v in stamps]
