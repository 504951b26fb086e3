"""Source tables to metric points: one row per config, period and dimension."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.config import MetricConfig
from tidewatch.functions.periods import as_utc, timestamp_literal, truncate
from tidewatch.operators.grid import joined_ranges

# Source timestamps outside this range are treated as garbage.
SANE_FROM, SANE_TO = datetime(2012, 1, 1), datetime(2099, 12, 31)

POINT_COLUMNS = ("config_name", "timestamp", "dimension_split_value", "value")
NULL_DIMENSION = "NA"

Ranges = list[tuple[datetime, datetime]]


def dimension_column(cfg: MetricConfig) -> Column:
    """The split as text; a missing value gets a name so that its key is not NULL."""
    if not cfg.dimension_split:
        return F.lit("")
    return F.coalesce(F.expr(cfg.dimension_split).cast("string"), F.lit(NULL_DIMENSION))


def scan_filter(source: DataFrame, cfg: MetricConfig, as_of: datetime, ranges: Ranges | None,
                sane: tuple[datetime, datetime]) -> Column:
    """Row filter on the untruncated timestamp, in that column's own type."""
    stamp = F.expr(cfg.source_timestamp_column_sql)
    kind = source.select(stamp).schema[0].dataType.simpleString()

    def literal(value: datetime) -> Column:
        return timestamp_literal(value, kind)

    low = max(as_utc(sane[0]), cfg.history_from(as_of))
    keep = (stamp >= literal(low)) & (stamp <= literal(as_utc(sane[1])))
    if ranges is not None:
        spans = [(stamp >= literal(first)) & (stamp < literal(end)) for first, end in ranges]
        keep = keep & (reduce(Column.__or__, spans) if spans else F.lit(False))
    if cfg.source_filter_sql:
        keep = keep & F.expr(cfg.source_filter_sql)
    return keep


def _scan_key(cfg: MetricConfig) -> tuple:
    return (cfg.source_project, cfg.source_dataset, cfg.source_table, cfg.source_timestamp_column_sql,
            cfg.source_filter_sql, cfg.dimension_split, cfg.period_length, str(cfg.history_start))


def aggregate_points(source: DataFrame, configs: list[MetricConfig], as_of: datetime,
                     ranges: Ranges | None = None,
                     sane: tuple[datetime, datetime] = (SANE_FROM, SANE_TO)) -> DataFrame:
    """Aggregate configs that share a scan in one pass over their source.

    All of them group by the same period and dimension, so one partial
    aggregation before the shuffle serves every value expression; the result
    is then turned from one column per config into one row per config.
    """
    lead = configs[0]
    if any(_scan_key(cfg) != _scan_key(lead) for cfg in configs):
        raise ValueError("configs do not share a scan")
    stamp = F.expr(lead.source_timestamp_column_sql).cast("timestamp")
    grouped = (
        source.filter(scan_filter(source, lead, as_of, ranges, sane))
        .groupBy(truncate(stamp, lead.period_length).alias("timestamp"),
                 dimension_column(lead).alias("dimension_split_value"))
        .agg(*[F.expr(cfg.source_forecast_column_sql).cast("double").alias(f"_v{i}")
               for i, cfg in enumerate(configs)])
    )
    if len(configs) == 1:
        return grouped.select(F.lit(lead.name).alias("config_name"), "timestamp", "dimension_split_value",
                              F.col("_v0").alias("value"))
    pairs = F.array(*[F.struct(F.lit(cfg.name).alias("config_name"), F.col(f"_v{i}").alias("value"))
                      for i, cfg in enumerate(configs)])
    return (grouped.select("timestamp", "dimension_split_value", F.explode(pairs).alias("_p"))
            .select("_p.config_name", "timestamp", "dimension_split_value", "_p.value"))


def custom_points(spark: SparkSession, cfg: MetricConfig, as_of: datetime,
                  missing: DataFrame | None = None) -> DataFrame:
    """Points of a config that brings its own query.

    ``{field}`` placeholders take config fields and ``{history_start}``; other braces stay as they are.
    ``{missing_timestamps_sql}`` becomes a subquery on the missing periods, or
    the timestamp expression itself on a full load (always true);
    ``{existing_timestamps_sql}`` is then never needed and gets a value no row has.
    """
    # Fixed value: a timestamp that marks "no period" and occurs in no series.
    never = "TIMESTAMP '1979-01-01 00:00:00'"
    wanted = cfg.source_timestamp_column_sql or "timestamp"
    if missing is not None:
        view = f"_missing_{uuid.uuid4().hex}"
        missing.filter(F.col("config_name") == cfg.name).select("timestamp").createOrReplaceTempView(view)
        wanted = f"SELECT timestamp FROM {view}"
    fields = {name: getattr(cfg, name) for name in (
        "source_project", "source_dataset", "source_table", "source_timestamp_column",
        "source_timestamp_column_sql", "source_forecast_column", "source_forecast_column_sql",
        "source_filter_sql", "dimension_split", "period_length")}
    fields |= {"history_start": cfg.history_from(as_of).isoformat(sep=" "),
               "missing_timestamps_sql": wanted, "existing_timestamps_sql": never}
    text = re.sub(r"\{(\w+)\}", lambda found: str(fields.get(found[1], found[0])), cfg.source_sql)
    try:
        rows = spark.sql(text)
        rows.schema  # resolves the view, which is then no longer needed
    finally:
        if missing is not None:
            spark.catalog.dropTempView(view)
    return rows.select(
        F.lit(cfg.name).alias("config_name"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.coalesce(F.col("dimension_split_value").cast("string"), F.lit(NULL_DIMENSION))
        .alias("dimension_split_value"),
        F.col("value").cast("double").alias("value"),
    )


def drop_newest(points: DataFrame, rows: int) -> DataFrame:
    """Leave out the newest periods, which may not be final yet.

    Works on aggregated points: the newest ``rows`` periods are found with a
    top-k, not by numbering the whole table in one task.
    """
    if rows <= 0:
        return points
    newest = points.select("timestamp").distinct().orderBy(F.desc("timestamp")).limit(rows)
    return points.join(F.broadcast(newest), "timestamp", "left_anti")  # at most ``rows`` rows


def build_points(spark: SparkSession, configs: Iterable[MetricConfig], read: Callable[[MetricConfig], DataFrame],
                 as_of: datetime, missing: DataFrame | None = None, ranges: dict[str, Ranges] | None = None,
                 sane: tuple[datetime, datetime] = (SANE_FROM, SANE_TO)) -> DataFrame:
    """Points of many configs, sharing scans where their definitions allow it.

    ``missing`` restricts a delta load to the wanted periods; ``ranges`` are
    the same periods as a few literals that prune the scan.  Configs that share
    a scan are read once over all their ranges; each keeps its own periods.
    """
    parts, shared = [], {}
    for cfg in configs:
        if cfg.source_sql:
            parts.append(drop_newest(custom_points(spark, cfg, as_of, missing), cfg.skip_newest_rows))
        elif cfg.skip_newest_rows:
            own = None if ranges is None else ranges.get(cfg.name, [])
            parts.append(drop_newest(aggregate_points(read(cfg), [cfg], as_of, own, sane), cfg.skip_newest_rows))
        else:
            shared.setdefault(_scan_key(cfg), []).append(cfg)
    for group in shared.values():
        wanted = None if ranges is None else joined_ranges(span for cfg in group for span in ranges.get(cfg.name, []))
        parts.append(aggregate_points(read(group[0]), group, as_of, wanted, sane))
    points = reduce(DataFrame.unionByName, [part.select(*POINT_COLUMNS) for part in parts])
    if missing is None:
        return points
    # Custom queries filter themselves where they want to; their raw timestamps need not be periods.
    exact = [cfg.name for cfg in configs if not cfg.source_sql]
    declared = points.filter(F.col("config_name").isin(exact)).join(
        missing, ["config_name", "timestamp"], "left_semi")
    return declared.unionByName(points.filter(~F.col("config_name").isin(exact)))


def describe_source(points: DataFrame, configs: Iterable[MetricConfig]) -> DataFrame:
    """Add the descriptive columns every stored version carries."""
    configs = list(configs)

    def per_config(pick: Callable[[MetricConfig], str]) -> Column:
        first = pick(configs[0])
        if all(pick(cfg) == first for cfg in configs):
            return F.lit(first)
        table = F.create_map(*[F.lit(item) for cfg in configs for item in (cfg.name, pick(cfg))])
        return F.element_at(table, F.col("config_name"))

    names = ("source_project", "source_dataset", "source_table", "source_timestamp_column",
             "source_timestamp_column_sql", "source_forecast_column", "source_forecast_column_sql",
             "source_sql", "period_length", "dimension_split")
    described = points.select("*", *[per_config(lambda cfg, n=name: getattr(cfg, n)).alias(name) for name in names])
    return described.withColumn("source_sql_hash", F.md5("source_sql"))


def current_values(table: DataFrame, config_name: str | None = None, dimension_split: str | None = None,
                   columns: Iterable[str] = ("timestamp", "value")) -> DataFrame:
    """Stored current values, without placeholders and NULL values."""
    rows = table.filter(F.col("is_latest"))
    if config_name is not None:
        rows = rows.filter(F.col("config_name") == config_name)
    if dimension_split is not None:
        rows = rows.filter(F.col("dimension_split") == dimension_split)
    # Fixed value: placeholder rows carry this timestamp.
    placeholder = timestamp_literal(datetime(1979, 1, 1))
    return rows.filter((F.col("timestamp") != placeholder) & F.col("value").isNotNull()).select(*columns)
