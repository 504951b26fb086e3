"""Streaming forms of the batch semantics: late data, unfinal periods, state, duplicates.

Each ``*_stream`` function builds the streaming DataFrame; each ``run_*``
function processes what is there (``availableNow``) and returns the result.
With a ``location`` the progress, state and table are kept below it, and the next
call with it goes on where this one ended; without, a call starts anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidewatch.config import MetricConfig
from tidewatch.functions.periods import FIXED_SECONDS, timestamp_literal
from tidewatch.operators.actuals import POINT_COLUMNS, SANE_FROM, SANE_TO, describe_source, dimension_column
from tidewatch.operators.versions import merge_versions, new_versions
from tidewatch.schemas import ACTUALS, REPLY_EVENTS
from tidewatch.session import ensure_checkpoint_dir, ship_package
from tidewatch.sources.tables import is_complete, list_folders, merge_months, read_partitioned, remove_folders

# Fixed value: how long a hash blocks its repeats.
HASH_WINDOW = "60 days"


def _folder(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def source_stream(spark: SparkSession, folder: str, files: str = "*.parquet",
                  files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as they arrive."""
    schema = spark.read.option("pathGlobFilter", files).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def metric_points_stream(source: DataFrame, cfg: MetricConfig, lateness: str) -> DataFrame:
    """Tumbling windows of one period; rows later than ``lateness`` are not counted any more.

    Windows have a fixed length, so months and longer periods are left to batch runs.
    """
    if cfg.period_length not in FIXED_SECONDS:
        raise ValueError(f"{cfg.name}: a stream needs periods of fixed length, not {cfg.period_length}")
    stamped = source.withColumn("_at", F.expr(cfg.source_timestamp_column_sql).cast("timestamp"))
    # before the watermark: one garbage stamp far ahead would make every later row late
    stamped = stamped.filter(F.col("_at").between(timestamp_literal(SANE_FROM), timestamp_literal(SANE_TO)))
    if cfg.source_filter_sql:
        stamped = stamped.filter(F.expr(cfg.source_filter_sql))
    # Windows are counted from a Thursday; weeks start on the Sunday three days later.
    offset = "3 days" if cfg.period_length == "week" else None
    length = f"1 {cfg.period_length}"
    period = F.window("_at", length, length, offset) if offset else F.window("_at", length)
    grouped = (stamped.withWatermark("_at", lateness)
               .groupBy(period.alias("_w"), dimension_column(cfg).alias("dimension_split_value"))
               .agg(F.expr(cfg.source_forecast_column_sql).cast("double").alias("value")))
    return grouped.select(F.lit(cfg.name).alias("config_name"), F.col("_w.start").alias("timestamp"),
                          "dimension_split_value", "value")


def _finish(writer, location: str) -> None:
    writer.option("checkpointLocation", f"{location}/progress").trigger(availableNow=True).start().awaitTermination()


def _to_parquet(stream: DataFrame, location: str) -> DataFrame:
    """Append a stream to a table and read it back."""
    table = f"{location}/table"
    _finish(stream.writeStream.outputMode("append").format("parquet").option("path", table), location)
    return stream.sparkSession.read.schema(stream.schema).parquet(table)


# So many batches, and so many folds of them, become one fold.
FOLD = 8


class Changes:
    """Newest row per key of the changes that micro-batches bring.

    Each batch is a folder named by its number and the first batch it stands for, at first the same.  Every ``FOLD`` batches are
    folded into one folder with the newest row of each key, every ``FOLD`` of these again, and so on: after n batches there are
    less than ``FOLD`` folders for each digit of n, and a row is rewritten once for each digit.  A fold counts once its write is
    committed, and what it stands for is removed after that; a repeated batch replaces its own folder or is part of a fold already.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], values: list[str]):
        self.spark, self.path, self.keys, self.values = spark, path, keys, values
        self.schema = T.StructType(schema.fields)

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/first={first}/batch={last}"

    def folders(self) -> list[tuple[int, int]]:
        """First and last batch of each committed folder that no other one stands for."""
        found = [(int(outer.rsplit("=", 1)[1]), int(inner.rsplit("=", 1)[1])) for outer in list_folders(self.spark, self.path)
                 for inner in list_folders(self.spark, outer) if is_complete(self.spark, inner)]
        return sorted(one for one in found if not any(other != one and other[0] <= one[0] and one[1] <= other[1] for other in found))

    def _newest(self, folders: list[tuple[int, int]]) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("first", T.LongType()), T.StructField("batch", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], self.schema).select(*self.keys, *self.values)
        rows = self.spark.read.schema(full).option("basePath", self.path).parquet(*[self._folder(*one) for one in folders])
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.values), "batch").alias("_v")).select(*self.keys, "_v.*")

    def add(self, batch: DataFrame, number: int) -> None:
        if not any(first <= number <= last and first < last for first, last in self.folders()):
            batch.write.mode("overwrite").parquet(self._folder(number, number))
        size = FOLD
        while (number + 1) % size == 0:
            first = number + 1 - size
            part = [one for one in self.folders() if first <= one[0] and one[1] <= number]
            if part != [(first, number)]:
                self._newest(part).write.mode("overwrite").parquet(self._folder(first, number))
            size *= FOLD
        self._tidy()

    def _tidy(self) -> None:
        """Remove folders that a committed fold stands for."""
        kept = {self._folder(*one) for one in self.folders()}
        tails = tuple(name[len(self.path):] for name in kept)
        for outer in list_folders(self.spark, self.path):
            inner = list_folders(self.spark, outer)
            old = [path for path in inner if not path.endswith(tails)]
            remove_folders(self.spark, [outer] if len(old) == len(inner) else old)

    def newest(self) -> DataFrame:
        return self._newest(self.folders())


def _newest(stream: DataFrame, location: str, keys: list[str], values: list[str]) -> DataFrame:
    """Newest row per key of a stream in update mode."""
    changes = Changes(stream.sparkSession, f"{location}/table", stream.schema, keys, values)
    _finish(stream.writeStream.outputMode("update").foreachBatch(changes.add), location)
    return changes.newest()


def run_metric_points(spark: SparkSession, folder: str, files: str, cfg: MetricConfig, lateness: str = "14 days",
                      location: str | None = None) -> DataFrame:
    """Points in update mode: each micro-batch replaces the points it changed."""
    stream = metric_points_stream(source_stream(spark, folder, files), cfg, lateness)
    keys = ["config_name", "timestamp", "dimension_split_value"]
    return _newest(stream, location or _folder(spark, "stream-points"), keys, ["value"]).select(*POINT_COLUMNS)


def run_final_points(spark: SparkSession, folder: str, files: str, cfg: MetricConfig, lateness: str,
                     location: str | None = None) -> DataFrame:
    """Points in append mode: a period appears once, when the watermark has passed it."""
    stream = metric_points_stream(source_stream(spark, folder, files), cfg, lateness)
    return _to_parquet(stream, location or _folder(spark, "stream-final")).select(*POINT_COLUMNS)


def run_versions(spark: SparkSession, folder: str, files: str, cfg: MetricConfig,
                 as_of: datetime | Callable[[int], datetime], lateness: str = "14 days",
                 files_per_batch: int | None = None, location: str | None = None) -> DataFrame:
    """Merge every micro-batch of changed points into a versioned table.

    ``as_of`` is the time of the merges, or gives it for the number of a batch.
    A batch replaces only the months it touches.  A repeated batch finds its own
    values there and changes nothing.
    """
    location = location or _folder(spark, "stream-versions")
    table = f"{location}/table"

    def merge(batch: DataFrame, number: int) -> None:
        now = as_of(number) if callable(as_of) else as_of
        fresh = new_versions(describe_source(batch, [cfg]), now)
        merge_months(table, fresh, ACTUALS, lambda held, rows: merge_versions(held, rows, now))

    stream = metric_points_stream(source_stream(spark, folder, files, files_per_batch), cfg, lateness)
    _finish(stream.writeStream.outputMode("update").foreachBatch(merge), location)
    return read_partitioned(spark, table, ACTUALS).select(*ACTUALS.names)


KEYS = ["incident_slack_ts", "dimension_split_value", "forecast_method"]
HELD = "announced string, posted_micros bigint, client_msg_id string"
# Fixed value: threads live 168 hours.
LIFE_MS = 168 * 3600 * 1000


class LastAnnouncement(StatefulProcessor):
    """Keeps the newest event of a key; of events of one instant the one with the smallest id.

    A timer forgets the key when its thread is past the cap.  Rows are looked at one after the other, so what a task holds
    is one event, however many a key has.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle, self._held = handle, handle.getValueState("held", HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = self._held.get()
        newest = tuple(before) if before is not None else None
        for row in rows:
            event = (row["announced"], row["posted_micros"], row["client_msg_id"])
            if newest is None or event[1] > newest[1] or (event[1] == newest[1] and event[2] < newest[2]):
                newest = event
        if before is not None and newest == tuple(before):
            return
        if before is not None:
            self._handle.deleteTimer(before[1] // 1000 + LIFE_MS)
        self._held.update(newest)
        self._handle.registerTimer(newest[1] // 1000 + LIFE_MS)
        yield Row(**dict(zip(KEYS, key)), announced=newest[0], posted_micros=newest[1], client_msg_id=newest[2])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self._held.clear()
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """State processors need the store that keeps its keys outside the heap; a query takes it when it starts for the first time."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def announced_state_stream(events: DataFrame, lateness: str = "168 hours") -> DataFrame:
    """Last announced class per incident, dimension and method as state; to be started within ``keyed_state``.

    The state is per key, not per thread, so a thread with very many
    dimensions is spread over tasks.  Events without a stamp have no place in the order and are left out.
    """
    ship_package(events.sparkSession)
    state = F.when(F.col("kind") == "resolve", F.lit("normal")).otherwise(F.col("anomaly_type_lower_higher"))
    named = events.filter((F.col("kind") != "summary") & F.col("posted_at").isNotNull()).select(
        "incident_slack_ts", F.coalesce("dimension_split_value", F.lit("")).alias("dimension_split_value"),
        F.coalesce("forecast_method", F.lit("")).alias("forecast_method"), state.alias("announced"), "posted_at",
        F.unix_micros("posted_at").alias("posted_micros"), F.coalesce("client_msg_id", F.lit("")).alias("client_msg_id"))
    output = "incident_slack_ts string, dimension_split_value string, forecast_method string, " + HELD
    newest = named.withWatermark("posted_at", lateness).groupBy(*KEYS).transformWithState(
        LastAnnouncement(), output, "update", "eventTime")
    return newest.withColumn("posted_at", F.timestamp_micros("posted_micros")).drop("posted_micros")


def run_announced_state(spark: SparkSession, path: str, location: str | None = None,
                        files_per_batch: int | None = None) -> DataFrame:
    """State after the whole stored event log, all its months, was streamed through."""
    reader = spark.readStream.schema(REPLY_EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    with keyed_state(spark):
        stream = announced_state_stream(reader.parquet(path))
        return _newest(stream, location or _folder(spark, "stream-announced"), KEYS, ["announced", "posted_at"])


def distinct_hashes_stream(source: DataFrame) -> DataFrame:
    """First event per hash; a repeat inside the window is dropped."""
    hashed = source.select(
        F.sha2(F.concat_ws("|", "event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("string")), 256)
        .alias("event_hash"), F.col("ts").cast("timestamp").alias("processed_at"))
    return hashed.withWatermark("processed_at", HASH_WINDOW).dropDuplicatesWithinWatermark(["event_hash"])


def run_distinct_hashes(spark: SparkSession, folder: str, files: str, location: str | None = None) -> DataFrame:
    stream = distinct_hashes_stream(source_stream(spark, folder, files))
    return _to_parquet(stream, location or _folder(spark, "stream-hashes")).select("event_hash")
