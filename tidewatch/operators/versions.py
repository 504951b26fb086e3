"""Versioned (SCD2) history: keys, merge, current rows, tombstones."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.periods import timestamp_literal
from tidewatch.schemas import ACTUALS, FORECASTS

# Fixed value: the end of validity of a version that is still current.
OPEN_END = datetime(9999, 12, 31, 23, 59, 59)
KEPT, CLOSED, INSERTED = "kept", "closed", "inserted"


def row_key(with_method: bool = False) -> Column:
    """Identity of a series point; parts are separated so they cannot run together."""
    parts = [F.col("config_name"), F.col("dimension_split"), F.col("dimension_split_value")]
    if with_method:
        parts.append(F.col("forecast_method"))
    return F.md5(F.concat_ws("|", *parts, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def new_columns(described: DataFrame, as_of: datetime) -> DataFrame:
    """Add what a row inserted at ``as_of`` has besides its description."""
    return described.withColumns({
        "key": row_key("forecast_method" in described.columns),
        "valid_from": timestamp_literal(as_of),
        "valid_to": timestamp_literal(OPEN_END),
        "is_latest": F.lit(True),
    })


def new_versions(described: DataFrame, as_of: datetime) -> DataFrame:
    """Rows as they would be inserted at ``as_of``."""
    schema = FORECASTS if "forecast_method" in described.columns else ACTUALS
    return new_columns(described, as_of).select(*schema.names)


def current_rows(table: DataFrame) -> DataFrame:
    return table.filter(F.col("is_latest"))


def require_unique(rows: DataFrame) -> DataFrame:
    """Fail the job when two incoming rows have the same key.

    The grouping is on the key the merge joins on, so it adds no second shuffle.
    """
    names = [name for name in rows.columns if name != "key"]
    grouped = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n"),
                                      F.first(F.struct(*names)).alias("_row"))
    clash = F.raise_error(F.concat(F.lit("duplicate key in incoming rows: "), F.col("key")))
    # a condition, so that the key stays the column the rows are partitioned by
    checked = grouped.filter(F.when(F.col("_n") > 1, clash.cast("boolean")).otherwise(F.lit(True)))
    return checked.select("key", "_row.*").select(*rows.columns)


def merge_versions(table: DataFrame, incoming: DataFrame, as_of: datetime, check_unique: bool = True,
                   describe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The table after ``incoming`` was merged at ``as_of``.

    A current row whose value differs (NULL-safe) is closed and the new value
    inserted; an equal value changes nothing; a new key is inserted; closed
    versions and keys absent from ``incoming`` stay as they are.

    The table is read once and only joined on its key, so a table that is stored
    in buckets of the key is not shuffled.  ``incoming`` may leave out columns
    that ``describe`` adds to the rows that are inserted.
    """
    names = table.columns
    if describe is None:
        incoming = incoming.select(*names)
    if check_unique:
        incoming = require_unique(incoming)
    held = table.select(F.col("key").alias("_key"), F.struct(*names).alias("_old"))
    fresh = incoming.select("key", F.struct(*incoming.columns).alias("_new"))
    both = held.join(fresh, (F.col("_key") == F.col("key")) & F.col("_old.is_latest"), "full_outer")
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = is_old & is_new & ~F.col("_old.value").eqNullSafe(F.col("_new.value"))
    outcome = F.array_compact(F.array(F.when(changed, CLOSED).when(is_old, KEPT),
                                      F.when(changed | ~is_old, INSERTED)))
    rows = both.select(F.explode(outcome).alias("_outcome"), "_old", "_new").select("_outcome", "_old", "_new.*")
    if describe is not None:
        rows = new_columns(describe(rows), as_of)
    inserted, closed = F.col("_outcome") == INSERTED, F.col("_outcome") == CLOSED
    ended = {"valid_to": timestamp_literal(as_of), "is_latest": F.lit(False)}
    return rows.select(*[
        F.when(inserted, F.col(name)).when(closed, ended.get(name, F.col("_old")[name])).otherwise(F.col("_old")[name]).alias(name)
        for name in names])


def tombstone(table: DataFrame, config_name: str) -> DataFrame:
    """Hide all versions of a config without deleting them."""
    return table.withColumn("is_latest", F.col("is_latest") & (F.col("config_name") != config_name))
