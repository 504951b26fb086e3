"""Stored tables: reading sources and seeds, writing partitioned outputs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch.schemas import CHANNELS, DESCRIPTIONS, REPLAY_ROWS, THRESHOLDS
from tidewatch.session import scratch, stored


def read_source(spark: SparkSession, location: str) -> DataFrame:
    """A source table: a Parquet path, or a name in the catalog."""
    if "/" in location or location.endswith(".parquet"):
        return spark.read.parquet(location)
    return spark.table(location)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV seed with a header; an empty field is NULL."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, multiLine=True,
                          quote='"', escape='"', nullValue="", emptyValue="")


def read_thresholds(spark: SparkSession, folder: str, environment: str) -> DataFrame:
    return read_seed(spark, f"{folder.rstrip('/')}/thresholds_{environment}.csv", THRESHOLDS)


def read_descriptions(spark: SparkSession, folder: str, environment: str) -> DataFrame:
    return read_seed(spark, f"{folder.rstrip('/')}/config_descriptions_{environment}.csv", DESCRIPTIONS)


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, CHANNELS)


def read_replay(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Exported delta rows; missing dates follow from the timestamp.

    A JSON array is one task's work for each file; with ``lines`` there is one object a line, and large files are split.
    """
    rows = spark.read.schema(REPLAY_ROWS).json(path, multiLine=not lines)
    return rows.withColumn("anomaly_date", F.coalesce("anomaly_date", F.to_date("timestamp")))


def month_of(column: str) -> Column:
    return F.date_format(F.date_trunc("month", column), "yyyy-MM")


# Order of rows within a partition's files, so that file statistics prune.
VERSION_ORDER = ("is_latest", "config_name", "dimension_split", "valid_to")
DELTAS_ORDER = ("config_name", "forecast_method", "actual_timestamp")


def write_partitioned(frame: DataFrame, path: str, stamp: str, order: tuple[str, ...] = (),
                      mode: str = "overwrite", replace_all: bool = False) -> None:
    """Write with a ``month`` partition taken from ``stamp``.

    ``overwrite`` replaces only the months that occur in ``frame`` unless
    ``replace_all``.  Rows are gathered by month and the leading order columns, and
    large groups are split by their size at run time; rows without a stamp share one partition.
    """
    rows = frame.withColumn("month", month_of(stamp))
    if order:
        spread = [name for name in order if name in ("config_name", "dimension_split_value", "forecast_method")]
        rows = rows.hint("rebalance", *map(F.col, ["month", *spread])).sortWithinPartitions("month", *order)
    writer = rows.write.mode(mode).partitionBy("month")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    writer.parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, parts: tuple[str, ...] = ("month",)) -> DataFrame:
    """Read a table written above; an absent one is empty.  The partition columns stay available for pruning."""
    full = T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in parts]])
    try:
        return spark.read.schema(full).parquet(path)
    except Exception as problem:  # noqa: BLE001 - only the missing path is expected
        if "PATH_NOT_FOUND" in str(problem):
            return spark.createDataFrame([], full)
        raise


def append_new(frame: DataFrame, path: str, schema: T.StructType, stamp: str, keys: list[str],
               order: tuple[str, ...] = ()) -> None:
    """Append the rows whose keys are not there yet, so that a repeated append adds nothing.

    Only the months that the rows fall into are looked up.  Rows need a stamp and keys; of rows with equal keys one is kept.
    """
    fresh = stored(frame.select(*schema.names, month_of(stamp).alias("month")).dropDuplicates(keys), "append")
    touched = [row[0] for row in fresh.select("month").distinct().collect()]  # one row per month
    if not touched:
        return
    held = read_partitioned(frame.sparkSession, path, schema).filter(F.col("month").isin(touched)).select(*keys)
    write_partitioned(fresh.join(held, keys, "left_anti").select(*schema.names), path, stamp, order, mode="append")


def merge_months(path: str, incoming: DataFrame, schema: T.StructType, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Merge into the months that ``incoming`` touches and replace only those.

    Rows without a timestamp belong to no month and are left out; the caller counts them.  The result of
    ``merge(table, incoming)`` is stored before the months are replaced, because a table cannot be overwritten while it is read.
    """
    spark = incoming.sparkSession
    with scratch(spark, "merge"):
        fresh = stored(incoming.filter(F.col("timestamp").isNotNull())
                       .select(*schema.names, month_of("timestamp").alias("month")), "incoming")
        touched = [row[0] for row in fresh.select("month").distinct().collect()]  # one row per month
        if touched:
            table = read_partitioned(spark, path, schema).filter(F.col("month").isin(touched)).select(*schema.names)
            merged = stored(merge(table, fresh.select(*schema.names)), "merged")
            write_partitioned(merged, path, "timestamp", VERSION_ORDER)


# Buckets of the key in the tables of versions.  Part of the stored layout: a table with another number has to be written anew.
BUCKETS = 16
Part = tuple[str, str]  # a config and a month


def versions_table(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """Name of the table of versions under ``path``, which the session's catalog gets to know if need be.

    It has a partition for each config and month, so runs of different configs replace nothing of each other, and buckets
    of the key, so that a merge does not shuffle what is stored.
    """
    name = f"tidewatch_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, config STRING, month STRING) USING parquet "
              f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (config, month) "
              f"CLUSTERED BY (key) SORTED BY (key) INTO {BUCKETS} BUCKETS LOCATION '{place}'")
    spark.catalog.refreshTable(name)  # other sessions write to it too
    return name


def in_parts(parts: Iterable[Part], config: str = "config", month: str = "month") -> Column:
    """Rows of some configs and months, as a condition that prunes partitions."""
    months: dict[str, list[str]] = {}
    for name, at in sorted(set(parts)):
        months.setdefault(name, []).append(at)
    return reduce(Column.__or__, [(F.col(config) == name) & F.col(month).isin(some) for name, some in months.items()], F.lit(False))


def parts_of(rows: DataFrame, stamp: str = "timestamp") -> list[Part]:
    """The configs and months of some rows: one row for each reaches the driver."""
    found = rows.filter(F.col(stamp).isNotNull()).select("config_name", month_of(stamp).alias("month")).distinct()
    return [(row[0], row[1]) for row in found.collect()]


def write_parts(frame: DataFrame, path: str, stamp: str, order: tuple[str, ...] = ()) -> None:
    """Replace the partitions by config and month that occur in ``frame``."""
    rows = frame.withColumns({"config": F.col("config_name"), "month": month_of(stamp)})
    if order:
        rows = rows.hint("rebalance", F.col("config"), F.col("month")).sortWithinPartitions("config", "month", *order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("config", "month").parquet(path)


def remove_parts(spark: SparkSession, path: str, parts: Iterable[tuple[str, ...]]) -> None:
    """Remove partitions: of a config, or of a config and month."""
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    remove_folders(spark, [f"{path}/" + "/".join(named(column, value) for column, value in zip(("config", "month"), part))
                           for part in parts])


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below a folder; none if it is absent."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [entry.getPath().toString() for entry in files.listStatus(folder) if entry.isDirectory()]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the write of a folder was committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
