"""Publication-lag statistics, duplicate suppression and status views."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidewatch.functions.periods import timestamp_literal
from tidewatch.functions.text import instant_literal_text, quoted_text
from tidewatch.operators.deltas import BUCKETS, NORMAL
from tidewatch.operators.transitions import COUNTS, announced_states, firing
from tidewatch.schemas import DEDUP_INDEX, schema_of
from tidewatch.session import scratch
from tidewatch.sources.tables import append_new, read_partitioned, write_partitioned

DELAY = "timestamp_delay_hour"
SKETCH = 10_000  # a sketched percentile is off by one in so many of the ranks at most
PARTS = 10_000  # shares are whole numbers of these


def _observed(publications: DataFrame) -> DataFrame:
    return publications.filter((F.col("date_interval") == "DAY") & F.col(DELAY).isNotNull()
                               & (F.col("date") >= F.col("first_valid_from_date")))


def _lags(publications: DataFrame, keys: list[str], shares: dict[str, float], recent: Column, exact: bool) -> DataFrame:
    """Per group: first day, observations, recent ones, smallest and largest delay, and the delays that reach the shares.

    Exact ones come from counts: equal delays of a group are one row before anything is shuffled, and the rows of a group are
    as many as it has different delays.  A share is reached by the first delay up to which so many observations lie.
    Otherwise one sketch of a fixed size does for all shares.
    """
    rows = _observed(publications)
    facts = [F.min("first_valid_from_date").alias("scraper_started"), F.count(F.lit(1)).alias("obs"),
             F.count_if(recent).alias("obs_last_90d")]
    if not exact:
        wanted = F.percentile_approx(DELAY, F.array(*[F.lit(share) for share in shares.values()]), F.lit(SKETCH)).alias("_p")
        sketched = rows.groupBy(*keys).agg(*facts, F.min(DELAY).alias("min_h"), F.max(DELAY).alias("max_h"), wanted)
        return sketched.withColumns({name: F.get("_p", F.lit(k)) for k, name in enumerate(shares)}).drop("_p")
    counted = rows.groupBy(*keys, DELAY).agg(*facts)
    group = Window.partitionBy(*keys)
    up_to = F.sum("obs").over(group.orderBy(DELAY).rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumns({"_up_to": up_to, "_all": F.sum("obs").over(group)})
    reached = {name: F.col("_up_to") * PARTS >= F.lit(round(share * PARTS)) * F.col("_all") for name, share in shares.items()}
    return placed.groupBy(*keys).agg(
        F.min("scraper_started").alias("scraper_started"), F.sum("obs").alias("obs"), F.sum("obs_last_90d").alias("obs_last_90d"),
        F.min(DELAY).alias("min_h"), F.max(DELAY).alias("max_h"),
        *[F.min(F.when(condition, F.col(DELAY))).alias(name) for name, condition in reached.items()])


def publication_lags(publications: DataFrame, as_of: datetime, exact: bool = False) -> DataFrame:
    """Per dataset: how long publication takes, and whether that is usable as expectation."""
    return _flagged(_lags(publications, ["dataset"], LAG_SHARES, _recent(as_of), exact))


LAG_SHARES = {"p5_h": 0.05, "p10_h": 0.1, "p25_h": 0.25, "median_h": 0.5}


def _recent(as_of: datetime) -> Column:
    return F.col("date") >= F.lit(as_of.date() - timedelta(days=90))


def _flagged(lags: DataFrame) -> DataFrame:
    hours = lags.withColumns({name: F.round(name) for name in ("min_h", *LAG_SHARES, "max_h")})
    # Fewer than 30 observations, two weeks, one week.
    flag = (F.when(F.col("obs") < 30, "INSUFFICIENT_DATA").when(F.col("obs_last_90d") == 0, "NO_RECENT_DATA")
            .when(F.col("min_h") > 24 * 14, "LIKELY_OBSOLETE")
            .when((F.col("min_h") == F.col("median_h")) & (F.col("min_h") > 24 * 7), "LONG_STABLE_CYCLE")
            .otherwise("OK"))
    return hours.select(
        "dataset", "scraper_started", "obs", "obs_last_90d", F.col("min_h").alias("expected_delay_hour_suggested"),
        F.ceil(F.col("min_h") / 24).cast("double").alias("expected_delay_day_suggested"),
        "p5_h", "p10_h", "p25_h", "median_h", "max_h", flag.alias("flag")).orderBy("dataset")


# Size of a stored sketch: a percentile of merged sketches is off by less than 1% of the ranks.
KLL_SIZE = 800
DAILY = schema_of(dataset=T.StringType(), date=T.DateType(), scraper_started=T.DateType(), obs=T.LongType(), min_h=T.DoubleType(),
                  max_h=T.DoubleType(), sketch=T.BinaryType())


def refresh_daily_lags(publications: DataFrame, path: str) -> None:
    """Write counts, extremes and a mergeable sketch of the delays of each dataset and day, by month.

    The months that occur in ``publications`` are replaced, so these have to be there as a whole; others stay as they are.
    Sketches have a bounded size and are made before the shuffle.  A dataset without observed delays has no row.
    """
    daily = _observed(publications).groupBy("dataset", "date").agg(
        F.min("first_valid_from_date").alias("scraper_started"), F.count(F.lit(1)).alias("obs"), F.min(DELAY).alias("min_h"),
        F.max(DELAY).alias("max_h"), F.kll_sketch_agg_double(DELAY, KLL_SIZE).alias("sketch"))
    write_partitioned(daily.select(*DAILY.names), path, "date")


def publication_lags_daily(spark: SparkSession, path: str, as_of: datetime) -> DataFrame:
    """``publication_lags`` from what ``refresh_daily_lags`` stored: sketches of days are merged, no publication is read."""
    daily = read_partitioned(spark, path, DAILY)
    merged = daily.groupBy("dataset").agg(
        F.min("scraper_started").alias("scraper_started"), F.sum("obs").alias("obs"),
        F.sum(F.when(_recent(as_of), F.col("obs")).otherwise(0)).alias("obs_last_90d"), F.min("min_h").alias("min_h"),
        F.max("max_h").alias("max_h"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("_sketch"))
    return _flagged(merged.withColumns({
        name: F.kll_sketch_get_quantile_double("_sketch", F.lit(share)) for name, share in LAG_SHARES.items()}))


def environment_comparison(publications: DataFrame, environments: tuple[str, str] = ("prod", "staging"),
                           exact: bool = False) -> DataFrame:
    """Per dataset: minimum and median delay of two environments side by side."""
    lags = _lags(publications, ["dataset", "environment"], {"median_h": 0.5}, F.lit(False), exact)
    rows = lags.withColumns({name: F.round(name) for name in ("min_h", "median_h")})
    here = {name: F.col("environment") == name for name in environments}
    return rows.groupBy("dataset").agg(
        *[(F.count_if(cond) > 0).alias(f"in_{name}") for name, cond in here.items()],
        *[F.max(F.when(cond, F.col(value))).alias(f"{name}_{value}")
          for value in ("min_h", "median_h") for name, cond in here.items()]).orderBy("dataset")


EVENT = ["config_name", "dimension_split_value", "forecast_method", "timestamp", "anomaly_type_lower_higher"]


def predicted_delay_anomalies(publications: DataFrame, config_name: str, environment: str = "prod",
                              above: float = 1.0) -> DataFrame:
    """Delay anomalies the next run will see, one per dataset and day."""
    late = (F.col("timestamp_delay_now_hypothetical_vs_expected_delay_hour") > above) & (
        F.col("date") >= F.col("first_valid_from_date"))
    rows = publications.filter((F.col("date_interval") == "DAY") & (F.col("environment") == environment) & late)
    return rows.select(
        F.lit(config_name).alias("config_name"), F.col("dataset").alias("dimension_split_value"),
        F.lit("constant_value").alias("forecast_method"), F.date_trunc("day", "timestamp").alias("timestamp"),
        F.lit("critical_higher").alias("anomaly_type_lower_higher")).distinct()


def event_hash() -> Column:
    texts = [instant_literal_text(F.col(name)) if name == "timestamp" else quoted_text(F.col(name)) for name in EVENT]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *texts), F.lit("]")), 256)


def new_event_hashes(deltas: DataFrame, index: DataFrame, as_of: datetime,
                     predicted: DataFrame | None = None) -> DataFrame:
    """Rows to append to the duplicate index: recent anomalies whose hash it does not hold."""
    recent = timestamp_literal(as_of - timedelta(hours=30 * 24))
    events = deltas.filter((F.col("anomaly_type") != NORMAL) & (F.col("timestamp") >= recent)).select(*EVENT)
    if predicted is not None:
        events = events.unionByName(predicted.select(*EVENT))
    dim = F.coalesce("dimension_split_value", F.lit("None"))
    stamp = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    text = F.concat(F.lit("[backfill] "), F.concat_ws(" / ", "config_name", dim, "forecast_method", stamp,
                                                      "anomaly_type_lower_higher"))
    hashed = events.select(event_hash().alias("event_hash"), timestamp_literal(as_of).alias("processed_at"),
                           text.alias("rendered_message"))
    known = index.filter(F.col("processed_at") >= timestamp_literal(as_of - timedelta(days=60))).select("event_hash")
    return hashed.join(known, "event_hash", "left_anti")


def append_hashes(hashes: DataFrame, path: str) -> None:
    """Append rows of ``new_event_hashes`` to the stored index; what its month holds already is not added again."""
    with scratch(hashes.sparkSession, "hashes"):
        append_new(hashes, path, DEDUP_INDEX, "processed_at", ["event_hash"], ("event_hash",))


def _severity() -> Column:
    return F.when(F.col("anomaly_type") == "critical", 2).when(F.col("anomaly_type") == "warning", 1).otherwise(0)


def _severity_name(column: str) -> Column:
    return F.when(F.col(column) == 2, "critical").when(F.col(column) == 1, "warning").otherwise(NORMAL)


def current_state(deltas: DataFrame) -> DataFrame:
    """Newest point of every series and method that has a forecast."""
    newest = Window.partitionBy("config_name", "forecast_method", "dimension_split_value").orderBy(F.desc("timestamp"))
    return (deltas.filter(F.col("forecast_method").isNotNull())
            .withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
            .select("config_name", "dimension_split_value", "forecast_method", "timestamp", "forecast_value",
                    "actual_value", "delta_rel", "anomaly_type", "anomaly_type_lower_higher"))


def config_rollup(deltas: DataFrame) -> DataFrame:
    """Per config: worst current class, critical and all dimensions, last anomaly."""
    state = current_state(deltas).groupBy("config_name", "dimension_split_value").agg(F.max(_severity()).alias("_s"))
    rolled = state.groupBy("config_name").agg(
        F.max("_s").alias("_worst"), F.count_if(F.col("_s") == 2).alias("critical_dimensions"),
        F.count(F.lit(1)).alias("dimensions"))
    fired = deltas.filter(F.col("anomaly_type") != NORMAL).groupBy("config_name").agg(
        F.max("timestamp").alias("last_fired"))
    return rolled.join(fired, "config_name", "left").select(
        "config_name", _severity_name("_worst").alias("severity"), "critical_dimensions", "dimensions", "last_fired")


def product_rollup(deltas: DataFrame, products: DataFrame) -> DataFrame:
    """Per product: worst class and number of affected configs; unmapped configs are their own product."""
    rolled = config_rollup(deltas).join(products.select("config_name", "product"), "config_name", "left")
    rank = F.when(F.col("severity") == "critical", 2).when(F.col("severity") == "warning", 1).otherwise(0)
    return rolled.groupBy(F.coalesce("product", "config_name").alias("product")).agg(
        F.max(rank).alias("_worst"), F.count_if(rank > 0).alias("affected_configs"),
        F.count(F.lit(1)).alias("configs"), F.max("last_fired").alias("last_fired"),
    ).select("product", _severity_name("_worst").alias("severity"), "affected_configs", "configs", "last_fired")


def severity_ribbon(deltas: DataFrame, as_of: datetime, days: int = 14) -> DataFrame:
    """Worst class of each config on each of the last days."""
    first = as_of.date() - timedelta(days=days - 1)
    kept = deltas.filter((F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(as_of.date())))
    return kept.groupBy("config_name", "date").agg(
        F.max(_severity()).alias("_worst"), F.count_if(F.col("anomaly_type") != NORMAL).alias("anomalies"),
    ).select("config_name", "date", _severity_name("_worst").alias("severity"), "anomalies")


def count_drift(incidents: DataFrame, events: DataFrame) -> DataFrame:
    """Open incidents whose stored counts differ from those the event log gives."""
    logged = announced_states(events).filter(firing("announced")).groupBy("incident_slack_ts").agg(
        *[F.count_if(F.col("announced") == b).alias(b) for b in BUCKETS])
    open_ones = incidents.filter(F.col("status") == "open").select(
        "config_name", "anomaly_date", "slack_ts", F.from_json("summary_counts_json", COUNTS).alias("_stored"))
    both = open_ones.join(logged, open_ones["slack_ts"] == logged["incident_slack_ts"], "left")
    same, columns = F.lit(True), []
    for bucket in BUCKETS:
        actual = F.coalesce(F.col(bucket), F.lit(0))
        same = same & F.coalesce(F.col("_stored")[bucket] == actual, F.lit(False))
        columns += [F.coalesce(F.col("_stored")[bucket], F.lit(-1)).alias(f"stored_{bucket}"),
                    actual.alias(f"logged_{bucket}")]
    return both.filter(~same).select("config_name", "anomaly_date", "slack_ts", *columns)


def stale_dimensions(points: DataFrame, periods: int, period: str) -> DataFrame:
    """Series whose newest value is at least ``periods`` periods behind their config's newest."""
    unit = {"quarter": "QUARTER", "week": "WEEK"}.get(period, period.upper())
    last = points.groupBy("config_name", "dimension_split_value").agg(F.max("timestamp").alias("last_seen"))
    newest = last.groupBy("config_name").agg(F.max("last_seen").alias("config_newest"))
    behind = F.timestamp_diff(unit, F.col("last_seen"), F.col("config_newest"))
    return (last.join(newest, "config_name").withColumn("periods_behind", behind)
            .filter(F.col("periods_behind") >= periods))


def close_open_incidents(incidents: DataFrame, config_name: str, as_of: datetime) -> DataFrame:
    """Resolve every open incident of a config."""
    chosen = (F.col("config_name") == config_name) & (F.col("status") == "open")
    return incidents.withColumns({
        "closed_at": F.when(chosen, timestamp_literal(as_of)).otherwise(F.col("closed_at")),
        "status": F.when(chosen, "resolved").otherwise(F.col("status")),
    })


def without_bootstrap(incidents: DataFrame, config_name: str) -> DataFrame:
    """Remove the markers that suppress the history of a config."""
    marker = F.coalesce(F.col("slack_ts"), F.lit("")).startswith("BOOTSTRAP-")
    return incidents.filter(~(marker & F.coalesce(F.col("config_name") == config_name, F.lit(False))))
