"""Actuals against forecasts: differences, classes, starts and ends of anomalies."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.periods import timestamp_literal
from tidewatch.operators.versions import OPEN_END
from tidewatch.session import stored

NORMAL = "normal"
# The classes, in the order in which they are tested.
CLASSES = (("critical_lower", "<"), ("warning_lower", "<"), ("critical_higher", ">"), ("warning_higher", ">"))
BUCKETS = ("critical_higher", "critical_lower", "warning_higher", "warning_lower")
STALE_DAYS = 60
POINT = ["config_name", "dimension_split_value", "timestamp"]
ORDERED_SERIES = ["config_name", "_method", "_dimension"]
DIGITS = 6


def current_forecasts(forecasts: DataFrame) -> DataFrame:
    return forecasts.filter(F.col("valid_to") == timestamp_literal(OPEN_END))


def newest_actuals(actuals: DataFrame) -> DataFrame:
    """``(config_name, newest)`` over current actuals.

    An aggregate that is joined back where it is needed: a window over the
    config would put all history of a config in one task.
    """
    return actuals.filter(F.col("is_latest")).groupBy("config_name").agg(F.max("timestamp").alias("newest"))


def live_configs(newest: DataFrame, as_of: datetime, days: int = STALE_DAYS) -> DataFrame:
    """Configs whose newest value is at most ``days`` whole days old."""
    return newest.filter(F.timestamp_diff("DAY", F.col("newest"), timestamp_literal(as_of)) <= days)


def live_actuals(actuals: DataFrame, as_of: datetime, days: int = STALE_DAYS) -> DataFrame:
    """Current actuals of live configs."""
    live = live_configs(newest_actuals(actuals), as_of, days).select("config_name")
    return actuals.filter(F.col("is_latest")).join(live, "config_name", "left_semi")


def due_forecasts(forecasts: DataFrame, newest: DataFrame) -> DataFrame:
    """Forecasts not later than the newest actual of their config.

    A later one cannot meet an actual, so dropping it before the join of
    both gives the same table as dropping it afterwards.
    """
    return (forecasts.join(newest, "config_name")
            .filter(F.col("timestamp") <= F.col("newest")).drop("newest"))


DEFINITION = ["source_sql_hash", "source_sql", "source_dataset_table", "source_dataset_table_column", "period_length"]


def _with_definition(versions: DataFrame) -> DataFrame:
    """Name the definition behind each version, with a short id for all of it."""
    dot, parts = F.lit("."), ["source_dataset", "source_table", "source_forecast_column"]
    dataset, table, column = [F.col(part) for part in parts]
    named = versions.withColumns({
        "source_dataset_table": F.concat(dataset, dot, table),
        "source_dataset_table_column": F.concat(dataset, dot, table, dot, column),
    })
    return named.withColumn("_definition", F.xxhash64(*[c for c in DEFINITION if c != "source_sql"]))


def match_points(actuals: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Full outer join on series and time; a missing actual counts as zero.

    The key is as fine as the data, so no key is hot.  NULL dimensions do
    not match (they are named before they are stored).  What describes the
    metric stays behind; ``_definition`` stands for it until ``add_definitions``.
    """
    left = _with_definition(actuals).select(
        *POINT, F.col("timestamp").alias("actual_timestamp"), F.col("value").alias("_actual"),
        F.col("valid_from").alias("delta_valid_from"), F.col("_definition").alias("_ac"), _span().alias("_ac_span"))
    right = _with_definition(forecasts).select(
        *POINT, "forecast_method", F.col("timestamp").alias("forecast_timestamp"), F.col("value").alias("_forecast"),
        F.col("_definition").alias("_fc"), _span().alias("_fc_span"))
    return left.join(right, POINT, "full_outer").select(
        "forecast_method", "forecast_timestamp", F.round("_forecast", DIGITS).alias("forecast_value"),
        "actual_timestamp", "delta_valid_from",
        F.round(F.coalesce("_actual", F.lit(0.0)), DIGITS).alias("actual_value"), *POINT,
        F.coalesce("_fc", "_ac").alias("_definition"), F.coalesce("_fc_span", "_ac_span").alias("_span"))


def _keyed(points: DataFrame) -> DataFrame:
    """Copies of the series columns that are never NULL: equal keys then mean equal layout."""
    none = F.lit("\0")  # occurs in no name
    return points.withColumns({"_method": F.coalesce("forecast_method", none),
                               "_dimension": F.coalesce("dimension_split_value", none)})


def unique_points(points: DataFrame, fine_grained: bool = True) -> DataFrame:
    """Without repeated rows, laid out by series and method for the ordering that follows.

    Rows that are equal agree in these columns too, so one shuffle serves
    both.  Seeds joined later are distinct themselves and add no repeats.
    """
    layout = [*ORDERED_SERIES, "_span"] if fine_grained else ORDERED_SERIES
    return _keyed(points).repartition(*layout).distinct()


def known_definitions(*versions: DataFrame) -> DataFrame:
    """Every definition behind stored versions; there are as many as were ever configured."""
    return reduce(DataFrame.union, [_with_definition(v).select("_definition", *DEFINITION) for v in versions]).distinct()


def add_definitions(points: DataFrame, known: DataFrame) -> DataFrame:
    """What the metric was when the row was stored: query, table, column, period.

    Carrying these texts with every row through the shuffles would cost far more than this join.
    """
    return points.withColumn("date", F.to_date("timestamp")).join(known, "_definition", "left").drop("_definition")


def add_thresholds(points: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Relative thresholds of the method.

    The size of the threshold table decides at run time whether it is broadcast.
    """
    limits = thresholds.select("config_name", "forecast_method", *[name for name, _ in CLASSES]).distinct()
    return points.join(limits, ["config_name", "forecast_method"], "left")


def add_bounds(points: DataFrame) -> DataFrame:
    """The values and distances the thresholds stand for."""
    fc = F.col("forecast_value")
    return points.withColumns({
        **{f"{name}_value": fc * (1 + F.col(name)) for name, _ in CLASSES},
        **{f"{name}_delta_threshold": fc * F.col(name) for name, _ in CLASSES},
    })


def add_descriptions(points: DataFrame, descriptions: DataFrame) -> DataFrame:
    texts = descriptions.select("config_name", "description", "dq_dashboard_url", "text_inject").distinct()
    return points.join(texts, "config_name", "left")


def add_differences(points: DataFrame) -> DataFrame:
    """Absolute and relative differences; a zero forecast has no relative one."""
    gap = F.col("actual_value") - F.col("forecast_value")
    relative = F.try_divide(gap, F.col("forecast_value"))
    with_gaps = points.withColumns({
        "delta": F.round(gap, DIGITS), "delta_rel": F.round(relative, DIGITS),
        "abs_delta": F.round(F.abs(gap), DIGITS), "abs_delta_rel": F.round(F.abs(relative), DIGITS),
    })
    rel = F.col("delta_rel")
    return with_gaps.withColumn("delta_rel_winsorised",
                                F.when(rel > 1, F.lit(1.0)).when(rel < -1, F.lit(-1.0)).otherwise(rel))


def classify(points: DataFrame) -> DataFrame:
    """Class of every point; NULL thresholds and differences never fire."""
    rel = F.round(F.try_divide(F.col("actual_value") - F.col("forecast_value"), F.col("forecast_value")), DIGITS)
    kind = F
    for name, side in CLASSES:
        kind = kind.when(rel < F.col(name) if side == "<" else rel > F.col(name), F.lit(name))
    return points.withColumn("anomaly_type_lower_higher", kind.otherwise(F.lit(NORMAL)))


def add_anomaly_values(points: DataFrame) -> DataFrame:
    """Threshold exceeded, coarse class, and the differences of anomalous points."""
    full = F.col("anomaly_type_lower_higher")
    exceeded = F
    for name, _ in CLASSES:
        exceeded = exceeded.when(full == name, F.col(name))
    coarse = points.withColumns({
        "exceeded_threshold_lower_higher": exceeded.otherwise(F.lit(0.0)),
        "anomaly_type": F.when(full.contains("critical"), "critical").when(full.contains("warning"), "warning")
        .otherwise(NORMAL),
    })
    odd = F.col("anomaly_type") != NORMAL
    return coarse.withColumns({
        "anomaly_value": F.when(odd, F.col("delta_rel")),
        "anomaly_value_windsorised": F.when(odd, F.col("delta_rel_winsorised")),
    })


def _span() -> Column:
    """Stretch of a series that is put in order by one task: a day of seconds, a month of minutes.

    An hourly series of a whole century has fewer than a million points and stays in one piece.
    """
    period, at = F.col("period_length"), F.col("timestamp")
    return (F.when(period == "second", F.date_trunc("day", at))
            .when(period == "minute", F.date_trunc("month", at))
            .otherwise(F.lit(datetime(1970, 1, 1))))


def stretch_ends(points: DataFrame) -> DataFrame:
    """The last class of each stretch of a series."""
    return points.groupBy(*ORDERED_SERIES, "_span").agg(F.max_by("anomaly_type_lower_higher", "timestamp").alias("_end"))


def previous_class(points: DataFrame, fine_grained: bool = True, before: DataFrame | None = None) -> DataFrame:
    """Add ``_previous``: the class of the point before in the same series and method.

    With periods of minutes or seconds a series is ordered in stretches, so
    that a very long one is not one task, and the last class of each stretch is
    handed to the next one that has points.  The ordered points are stored in
    between: the hand-over reads a few columns of them and is joined by its size.
    ``before`` has the ends of stretches that are not among the points.
    """
    kind, names = F.col("anomaly_type_lower_higher"), points.columns
    keyed = points if "_method" in names else _keyed(points)
    if not fine_grained:
        return keyed.withColumn("_previous", F.lag(kind).over(
            Window.partitionBy(*ORDERED_SERIES).orderBy("timestamp"))).select(*names, "_previous")
    stretch = [*ORDERED_SERIES, "_span"]
    within = Window.partitionBy(*stretch).orderBy("timestamp")
    spanned = keyed if "_span" in names else keyed.withColumn("_span", _span())
    inside = stored(spanned.withColumns({"_inside": F.lag(kind).over(within),
                                         "_rank": F.row_number().over(within)}), "ordered")
    ends = stretch_ends(inside)
    if before is not None:
        ends = ends.unionByName(before.select(*ends.columns))
    carried = ends.withColumn("_carried", F.lag("_end").over(
        Window.partitionBy(*ORDERED_SERIES).orderBy("_span"))).filter(F.col("_carried").isNotNull())
    joined = inside.join(stored(carried.drop("_end"), "carried"), stretch, "left")
    previous = F.when(F.col("_rank") == 1, F.col("_carried")).otherwise(F.col("_inside"))
    return joined.withColumn("_previous", previous).select(*names, "_previous")


def mark_changes(points: DataFrame, fine_grained: bool = True, before: DataFrame | None = None) -> DataFrame:
    """Mark where an anomaly starts and ends."""
    kind, earlier = F.col("anomaly_type_lower_higher"), F.col("_previous")
    return previous_class(points, fine_grained, before).withColumns({
        "anomaly_type_lower_higher_start": F.when((kind != NORMAL) & (earlier == NORMAL), kind),
        "anomaly_type_lower_higher_end": F.when((kind == NORMAL) & (earlier != NORMAL), earlier),
    }).drop("_previous")


def debounce(points: DataFrame) -> DataFrame:
    """Values of anomalous points at the start of the anomaly only."""
    starts = F.col("anomaly_type_lower_higher_start") != NORMAL
    return points.withColumns({
        "anomaly_value_windsorised_debounced": F.when(starts, F.col("anomaly_value_windsorised")),
        "anomaly_value_debounced": F.when(starts, F.col("anomaly_value")),
        "actual_value_debounced": F.when(starts, F.col("actual_value")),
    })


def build_deltas(actuals: DataFrame, forecasts: DataFrame, thresholds: DataFrame, descriptions: DataFrame,
                 as_of: datetime, fine_grained: bool = True,
                 keep: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """The deltas table from the stored versions of actuals and forecasts.

    The newest value per config and the definitions are stored first (``keep``): as
    tables of known size they are broadcast or not by that size, while as
    subqueries of unknown size they would make the big side be shuffled by config.
    """
    current, predicted = actuals.filter(F.col("is_latest")), current_forecasts(forecasts)
    newest = keep(live_configs(newest_actuals(actuals), as_of), "newest")
    known = keep(known_definitions(current, predicted), "definitions")
    live = current.join(newest.select("config_name"), "config_name", "left_semi")
    points = unique_points(match_points(live, due_forecasts(predicted, newest)), fine_grained)
    # Only what the ordering needs goes through it; the other columns follow from these afterwards.
    return add_columns(mark_changes(classify(add_thresholds(points, thresholds)), fine_grained), descriptions, known)


def add_columns(marked: DataFrame, descriptions: DataFrame, known: DataFrame) -> DataFrame:
    """Everything that follows from a point, its class and its thresholds."""
    valued = debounce(add_anomaly_values(add_differences(add_bounds(marked.drop("_span", "_method", "_dimension")))))
    return add_definitions(add_descriptions(valued, descriptions), known)
