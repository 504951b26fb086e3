"""Statistics of the last N values before each period to forecast.

Row counts, not time spans, define the window, so gaps in a series do not
shorten it.  Numbering the values of a series turns the as-of lookup into a
range frame: a grid row carries the number of values before it, and the frame
``[number - N + 1, number]`` holds exactly the last N of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.functions.periods import period_at, timestamp_literal

SERIES = ["config_name", "dimension_split_value"]

STATISTICS = {
    "mean": F.avg,
    "median": lambda column: F.percentile(column, F.lit(0.5)),
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
}

_SLICE = 10_000  # periods generated per exploded row


@dataclass(frozen=True)
class Statistic:
    """``rows`` values before the period."""

    alias: str
    name: str
    rows: int


def needed_history(train: DataFrame, first: datetime, rows: int) -> DataFrame:
    """Values from ``first`` on, plus the last ``rows`` of each series before it.

    Spark applies the ranking filter before the shuffle as well, so a run
    over a few periods does not move years of history.
    """
    boundary = timestamp_literal(first)
    latest = Window.partitionBy(*SERIES).orderBy(F.desc("timestamp"))
    older = (train.filter(F.col("timestamp") < boundary)
             .withColumn("_rank", F.row_number().over(latest))
             .filter(F.col("_rank") <= rows).drop("_rank"))
    return older.unionByName(train.filter(F.col("timestamp") >= boundary))


def with_grid_rows(values: DataFrame, first: datetime, total: int, period: str) -> DataFrame:
    """Add one row per series and period, flagged ``_grid`` and without a value.

    They are produced from one row of each series after the shuffle by
    series, so neither a second scan for the list of series nor a join is needed.
    """
    series = Window.partitionBy(*SERIES)
    own = F.array(F.lit(-1).cast("long"))
    last_slice = F.lit(max(total - 1, 0) // _SLICE).cast("long")
    slices = F.concat(own, F.sequence(F.lit(0).cast("long"), last_slice)) if total > 0 else own
    is_last = F.row_number().over(series.orderBy(F.desc("timestamp"))) == 1
    sliced = (values.withColumn("_last", is_last)
              .select("*", F.explode(F.when(F.col("_last"), slices).otherwise(own)).alias("_slice")))
    low = F.col("_slice") * _SLICE
    periods = F.sequence(low, F.least(low + (_SLICE - 1), F.lit(total - 1).cast("long")))
    rows = sliced.select("*", F.explode(F.when(F.col("_slice") < 0, own).otherwise(periods)).alias("_index"))
    grid = F.col("_index") >= 0
    return rows.select(
        *SERIES,
        F.when(grid, period_at(first, F.col("_index"), period)).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(~grid, F.col("value")).alias("value"),
        grid.alias("_grid"),
    )


def rolling_statistics(train: DataFrame, statistics: list[Statistic], first: datetime, total: int,
                       period: str, cut_history: bool = True) -> DataFrame:
    """One row per series and period with a column per statistic.

    ``train`` has ``config_name, dimension_split_value, timestamp, value``.
    A statistic is NULL where the series has fewer values than it needs.
    The rows of one series in one task are its last N values and the horizon:
    both are parameters of the run, neither grows with the source tables.
    ``cut_history=False`` saves the cut where the horizon is the whole history.
    """
    values = train.select(*SERIES, "timestamp", "value")
    if cut_history:
        values = needed_history(values, first, max(item.rows for item in statistics))
    series = Window.partitionBy(*SERIES)
    # At the same instant the grid row comes first: only strictly earlier values count.
    in_time = series.orderBy("timestamp", F.desc("_grid")).rowsBetween(Window.unboundedPreceding, 0)
    numbered = with_grid_rows(values, first, total, period).withColumn(
        "_number", F.count(F.when(~F.col("_grid"), 1)).over(in_time))
    by_number = series.orderBy("_number")
    columns = {}
    for item in statistics:
        column = STATISTICS[item.name](F.col("value")).over(by_number.rangeBetween(1 - item.rows, 0))
        columns[item.alias] = F.when(F.col("_number") >= item.rows, column)
    return numbered.withColumns(columns).filter("_grid").select(
        *SERIES, "timestamp", *[item.alias for item in statistics])


def prefix_statistics(train: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """``(config_name, dimension_split_value, timestamp, value)``: a statistic of all values before each asked period.

    ``asked`` has distinct series and timestamps.  Sum, mean, smallest and largest value run along each series once.  Periods
    without a value before them give none.
    """
    own = train.select(*SERIES, "timestamp", "value").join(asked.select(*SERIES).distinct(), SERIES, "left_semi")
    if name == "median":
        return _prefix_median(own, asked)
    rows = own.withColumn("_asked", F.lit(False)).unionByName(
        asked.select(*SERIES, "timestamp", F.lit(None).cast("double").alias("value"), F.lit(True).alias("_asked")))
    # At the same instant the asked row comes first: only strictly earlier values count.
    so_far = Window.partitionBy(*SERIES).orderBy("timestamp", F.desc("_asked")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("value", STATISTICS[name](F.col("value")).over(so_far)).filter("_asked").drop("_asked").dropna(subset="value")


def _prefix_median(values: DataFrame, asked: DataFrame) -> DataFrame:
    """Medians of prefixes by counting.

    The n values of a series are cut into root n ranges of value.  Running counts along time say how many values each range has
    before an asked period, hence the range that holds the middle ones; only that range's values are then looked at.  So a
    period costs about two root n rows instead of n.
    """
    series = Window.partitionBy(*SERIES)
    rank = F.row_number().over(series.orderBy("value", "timestamp")) - 1
    ranked = values.withColumns({"_rank": rank, "_n": F.count(F.lit(1)).over(series)}).withColumn(
        "_range", F.floor(F.col("_rank") / F.ceil(F.sqrt("_n"))))
    probes = asked.select(*SERIES, "timestamp").join(ranked.select(*SERIES, "_range").distinct(), SERIES)
    both = ranked.select(*SERIES, "_range", "timestamp", F.lit(False).alias("_asked")).unionByName(
        probes.withColumn("_asked", F.lit(True)))
    so_far = Window.partitionBy(*SERIES, "_range").orderBy("timestamp", F.desc("_asked")).rowsBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn("_count", F.count_if(~F.col("_asked")).over(so_far)).filter("_asked")
    period = Window.partitionBy(*SERIES, "timestamp")
    placed = counted.withColumns({
        "_up_to": F.sum("_count").over(period.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)),
        "_all": F.sum("_count").over(period)})
    middle = F.array_distinct(F.array(F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)))
    below = F.col("_up_to") - F.col("_count")
    hits = placed.select("*", F.explode(middle).alias("_middle")).filter(
        (F.col("_middle") >= below) & (F.col("_middle") < F.col("_up_to"))).select(
        *SERIES, "_range", F.col("timestamp").alias("_period"), "_middle", (F.col("_middle") - below).alias("_place"))
    inside = hits.join(ranked, [*SERIES, "_range"]).filter(F.col("timestamp") < F.col("_period"))
    place = F.row_number().over(Window.partitionBy(*SERIES, "_period", "_middle").orderBy("_rank")) - 1
    found = inside.withColumn("_at", place).filter(F.col("_at") == F.col("_place"))
    return found.groupBy(*SERIES, F.col("_period").alias("timestamp")).agg(F.avg("value").alias("value"))
