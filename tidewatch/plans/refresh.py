"""The stored deltas: what a run touched is built anew, the rest stays.

A point's class follows from the point alone, so a change reaches no further than the first point after it, whose anomaly
may now start or end there.  Kept beside the deltas are the last class of each series and month (``deltas_ends``), what they
were built with (``deltas_state``: newest actual and settings of each config), and which months wait (``deltas_pending``).
All are partitioned by config, and nothing of other configs is replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.operators.deltas import (
    ORDERED_SERIES, add_columns, add_thresholds, classify, current_forecasts, due_forecasts, known_definitions,
    live_configs, mark_changes, match_points, newest_actuals, stretch_ends, unique_points,
)
from tidewatch.schemas import ACTUALS, DELTAS_ENDS, DELTAS_PENDING, DELTAS_STATE, FORECASTS
from tidewatch.session import stored
from tidewatch.sources.tables import (
    DELTAS_ORDER, Part, in_parts, month_of, parts_of, read_partitioned, remove_parts, write_parts,
)


def mark_pending(spark: SparkSession, root: str, parts: Iterable[Part]) -> None:
    """Note that months wait to be built; before they are merged, so that a run that breaks off leaves the note."""
    rows = spark.createDataFrame([(name, month, name, uuid.uuid4().hex) for name, month in sorted(set(parts))],
                                 "config_name string, waiting string, config string, run string")
    _write_small(rows, f"{root}/deltas_pending", "config", "run")


def _write_small(rows: DataFrame, path: str, *parts: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _settings(thresholds: DataFrame, descriptions: DataFrame) -> DataFrame:
    """One number for the thresholds and texts of each config; both tables are a user's small files."""
    rows = [frame.select("config_name", F.xxhash64(F.lit(tag), *frame.columns).alias("_row"))
            for tag, frame in (("limits", thresholds), ("texts", descriptions))]
    each = rows[0].unionByName(rows[1]).distinct()
    return each.groupBy("config_name").agg(F.bit_xor("_row").cast("string").alias("settings"))


def _months_between(first: str, last: str) -> list[str]:
    """Months from one to another, whichever is earlier."""
    low, high = sorted(int(month[:4]) * 12 + int(month[5:]) - 1 for month in (first, last))
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in range(low, high + 1)]


def _classified(actuals: DataFrame, forecasts: DataFrame, newest: DataFrame, thresholds: DataFrame, wanted: Column) -> DataFrame:
    """Classes of the points of some configs and months; a series is ordered in stretches of a month at most."""
    due = due_forecasts(current_forecasts(forecasts.filter(wanted)), newest)
    points = match_points(actuals.filter(wanted & F.col("is_latest")), due).withColumn(
        "_span", F.greatest("_span", F.date_trunc("month", "timestamp")))
    return classify(add_thresholds(unique_points(points), thresholds))


def _month_ends(points: DataFrame) -> DataFrame:
    """The last class of each series and month, with the stretch it closes."""
    ends = stretch_ends(points).withColumn("month", month_of("_span"))
    return ends.groupBy(*ORDERED_SERIES, "month").agg(F.max("_span").alias("_span"), F.max_by("_end", "_span").alias("_end"))


def _followers(before: DataFrame, after: DataFrame, others: DataFrame) -> list[Part]:
    """Months outside the built ones whose first point of a series follows a class that is another one now."""
    key = [*ORDERED_SERIES, "month"]
    old = before.select(*key, F.col("_end").alias("_was"))
    built = old.join(after.select(*key, "_end"), key, "full_outer").withColumn("_changed", ~F.col("_was").eqNullSafe(F.col("_end")))
    marks = built.select(*key, "_changed", F.lit(True).alias("_built")).unionByName(
        others.select(*key, F.lit(False).alias("_changed"), F.lit(False).alias("_built")))
    # of the months of a series in order: one that follows a changed one
    follows = F.lag("_changed").over(Window.partitionBy(*ORDERED_SERIES).orderBy("month"))
    found = marks.withColumn("_follows", follows).filter("_follows AND NOT _built").select("config_name", "month").distinct()
    return [(row[0], row[1]) for row in found.collect()]  # one row for each config and month


def refresh_deltas(spark: SparkSession, root: str, names: Iterable[str], thresholds: DataFrame, descriptions: DataFrame,
                   as_of: datetime) -> list[Part]:
    """Bring the stored deltas of some configs up to date; returns the configs and months that were written.

    Built are the months that wait, those from the newest actual of the last time to the newest now (forecasts became due
    there), and those that ``_followers`` finds.  A config without stored deltas, or with other thresholds or texts than last
    time, is built whole.  Of a config whose newest actual is too old, whether it is one of ``names`` or not, nothing stays.
    """
    names = sorted(set(names))
    paths = {name: f"{root}/{name}" for name in ("deltas", "deltas_ends", "deltas_state", "deltas_pending")}
    own = F.col("config").isin(names)
    actuals = _read(spark, f"{root}/actuals", ACTUALS).filter(own)
    forecasts = _read(spark, f"{root}/forecasts", FORECASTS).filter(own)
    newest = stored(live_configs(newest_actuals(actuals), as_of), "newest")
    current = newest.join(_settings(thresholds, descriptions), "config_name", "left")
    # one row for each config
    month = month_of("newest").alias("month")
    now = {row["config_name"]: row for row in current.select("config_name", "settings", month).collect()}
    stored_state = read_partitioned(spark, paths["deltas_state"], DELTAS_STATE, ("config",))
    live = live_configs(stored_state, as_of).select("config_name", F.lit(True).alias("live"))
    state = {row["config_name"]: row for row in stored_state.join(live, "config_name", "left").select(
        "config_name", "settings", month, "live").collect()}
    waiting = [(row[0], row[1]) for row in read_partitioned(
        spark, paths["deltas_pending"], DELTAS_PENDING, ("config", "run")).filter(own).select(
        "config_name", "waiting").distinct().collect()]

    gone = [name for name in names if name not in now] + [
        name for name, row in state.items() if name not in names and not row["live"]]
    for path in ("deltas", "deltas_ends", "deltas_state"):
        remove_parts(spark, paths[path], [(name,) for name in gone])

    whole, parts = [], set()
    for name, row in now.items():
        last = state.get(name)
        if last is None or last["settings"] != row["settings"]:
            whole.append(name)
        else:
            parts |= {part for part in waiting if part[0] == name}
            parts |= {(name, month) for month in _months_between(last["month"], row["month"])}
    if whole:
        parts |= set(parts_of(actuals.filter(F.col("config").isin(whole)))) | set(parts_of(forecasts.filter(F.col("config").isin(whole))))
    parts = sorted(parts)
    if not parts:
        return []

    built = stored(_classified(actuals, forecasts, newest, thresholds, in_parts(parts)), "classified")
    ends = _read(spark, paths["deltas_ends"], DELTAS_ENDS).filter(own)
    after = stored(_month_ends(built), "ends")
    others = ends.filter(~in_parts(parts))
    more = _followers(ends.filter(in_parts(parts)), after, others)
    if more:
        built = built.unionByName(_classified(actuals, forecasts, newest, thresholds, in_parts(more)))
    written = sorted({*parts, *more})
    outside = ends.filter(~in_parts(written))
    marked = mark_changes(built, True, outside)
    known = stored(known_definitions(actuals.filter(in_parts(written) & F.col("is_latest")),
                                     current_forecasts(forecasts.filter(in_parts(written)))), "definitions")
    deltas = stored(add_columns(marked, descriptions, known), "deltas")
    write_parts(deltas, paths["deltas"], "timestamp", DELTAS_ORDER)
    filled = set(parts_of(deltas))
    for path in ("deltas", "deltas_ends"):
        remove_parts(spark, paths[path], [part for part in written if part not in filled])
    write_parts(after.select(*DELTAS_ENDS.names), paths["deltas_ends"], "_span")
    _write_small(current.select(*DELTAS_STATE.names, F.col("config_name").alias("config")), paths["deltas_state"], "config")
    remove_parts(spark, paths["deltas_pending"], [(name,) for name in names])
    return written


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_partitioned(spark, path, schema, ("config", "month"))
