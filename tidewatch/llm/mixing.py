"""Mixing sources to target weights: entropy balancing of document rates, rounded into copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.llm.rows import numbered
from tidewatch.session import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5  # of all words, what the mix takes
LIMIT = 2.0  # copies of a document at most
STEPS = 60
LANES = 64  # the documents of a source with one size are met in so many parts
WORD_BREAKS = r"[\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of runs of other characters than space and tab to carriage return; null: 0."""
    trimmed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_BREAKS, -1))).cast("long")


def _key(source: str) -> Column:
    """A source's name that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   limit: float = LIMIT) -> DataFrame:
    """``(source, source_size, target)``: ``share`` of all sizes by weight; what exceeds ``limit`` times a source is reshared.

    Weights repeat over the sources by code point, null last.  Only three sums reach the driver in each round; a source
    that has met its limit stays there, so the rounds end.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("row_number") % len(weights) + 1).cast("int"))
    rows = stored(ranked.select("source", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size") * limit
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level > cap
        capped, number, room, total = rows.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum("source_size"), F.lit(0))).first()
        if number == full or not room:
            break
        level, full = (share * total - capped) / room, number
    return rows.select("source", "source_size", F.least(F.col("weight") * level, cap).cast("double").alias("target"))


def tilts(histogram: DataFrame, targets: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``(source, scale, tilt)``: rates ``min(limit, exp(tilt * size / scale))`` whose words meet each source's target.

    These rates are the ones nearest to one copy of each document in relative entropy, under the token constraint; the
    tilt is the variable of the convex dual.  Newton steps run for all sources at once over ``histogram`` (source, size,
    n), each followed by a check: a step out of the bracket is halved back.  A tilt is kept to nine digits, so that the
    order in which sums are added does not show.
    """
    data = histogram.filter("size > 0")
    mean = data.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"),
                                      F.min("size").alias("least"))
    state = stored(targets.join(mean, targets["source"].eqNullSafe(mean["source"])).select(
        targets["source"], "target", "source_size", "scale", "least", F.lit(0.0).alias("tilt"), F.lit(-700.0).alias("low"),
        (F.lit(np.log(limit)) * F.col("scale") / F.col("least")).alias("high"), F.lit(False).alias("done")), "tilts")
    for _ in range(STEPS):
        open_ = state.filter(~F.col("done"))
        rate = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(np.log(limit))))
        words = F.col("size") * F.col("n") * rate
        free = F.col("tilt") * F.col("size") / F.col("scale") < float(np.log(limit))
        sums = data.join(open_.select(F.col("source").alias("_s"), "tilt", "scale"),
                         data["source"].eqNullSafe(F.col("_s"))).groupBy("_s").agg(
            F.sum(words).alias("value"), F.sum(F.when(free, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"))
        gap = F.col("value") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("_low")) & (step < F.col("_high"))
        moved = (state.join(sums, state["source"].eqNullSafe(sums["_s"]), "left")
                 .withColumn("_low", low).withColumn("_high", high)
                 .withColumn("_new", F.when(inside, step).otherwise((F.col("_low") + F.col("_high")) / 2))
                 .withColumn("_met", F.col("done") | F.col("value").isNull() | (F.abs(gap) <= F.col("target") * 1e-9)
                             | (F.col("_high") - F.col("_low") < 1e-12)))
        state = stored(moved.select(
            "source", "target", "source_size", "scale", "least",
            F.when(F.col("_met"), F.col("tilt")).otherwise(F.col("_new")).alias("tilt"),
            F.when(F.col("_met"), F.col("low")).otherwise(F.col("_low")).alias("low"),
            F.when(F.col("_met"), F.col("high")).otherwise(F.col("_high")).alias("high"),
            F.col("_met").alias("done")), "tilts")
        if not state.filter(~F.col("done")).head(1):
            break
    return state.select("source", "scale", F.round("tilt", 9).alias("tilt"))


def _round_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of all ``n`` documents of a size, for sizes that come source by source, large ones first.

    What a size is rounded by is carried to the next one of its source.  ``_least`` is what each document gets at least,
    ``_more`` the number of documents that get one more.
    """
    source, carried = None, 0.0
    for batch in batches:
        sources, sizes, counts, rates = (batch.column(k).to_pylist() for k in ("_source", "size", "n", "_rate"))
        least, more = [0] * len(sizes), [0] * len(sizes)
        for i, (key, size, n, rate) in enumerate(zip(sources, sizes, counts, rates)):
            if key != source:
                source, carried = key, 0.0
            if size:
                least[i] = int(rate)
                wanted = (rate - least[i]) * n * size + carried
                more[i] = min(max(int(wanted / size + 0.5), 0), n if rate > least[i] else 0)
                carried = wanted - more[i] * size
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64()), pa.array(more, pa.int64())],
                                         [*batch.schema.names, "_least", "_more"])


def mix_sources(documents: DataFrame, keep: list[str], narrow: bool = True, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                limit: float = LIMIT) -> DataFrame:
    """Columns ``keep`` of each document with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``limit``).

    A document without words takes no part (no copies); a source without words has target 0.  A null source is a source
    of its own.  Repeated rows count each.  ``narrow`` columns are stored once with their sizes, others are read
    twice.  One remainder runs along the sizes of a source; among documents of one size the larger number of copies is
    dealt evenly along (part, doc_id), so reruns agree.
    """
    rows = documents.select(*keep, word_count().alias("size"))
    if narrow:
        rows = stored(rows, "sizes")
    # a few sources can hold most rows: the documents of one size are counted and met in parts
    part = F.pmod(F.xxhash64("doc_id"), F.lit(LANES)).cast("int")
    counted = stored(rows.groupBy("source", "size", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")), "counted")
    histogram = stored(counted.groupBy("source", "size").agg(F.sum("_n").alias("n")), "histogram")
    targets = stored(source_targets(histogram.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, limit), "targets")
    solved = tilts(histogram, targets, limit)
    plan = stored(targets.join(solved.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
                  .select(_key("source").alias("_source"), "source_size", "target", "scale", "tilt"), "plan")
    rate = F.when(F.col("target") >= F.col("source_size") * limit, F.lit(limit)).otherwise(
        F.least(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(float(np.log(limit))))), F.lit(limit)))
    rated = histogram.select(_key("source").alias("_source"), "size", "n").join(plan, "_source").select(
        "_source", "size", "n", "source_size", "target", F.coalesce(F.when(F.col("size") > 0, rate), F.lit(0.0)).alias("_rate"))
    along = rated.repartition("_source").sortWithinPartitions("_source", F.desc("size"))
    schema = T.StructType([*along.schema.fields, T.StructField("_least", T.LongType()), T.StructField("_more", T.LongType())])
    rounded = stored(along.mapInArrow(_round_sizes, schema), "rounded")
    earlier = Window.partitionBy("source", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counted.select(_key("source").alias("_source"), "size", "_part",
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    dealt = stored(parts.join(rounded, ["_source", "size"]).withColumnRenamed("size", "_size"), "dealt")
    keys = ["_source", "_size", "_part"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id")).cast("long")
    placed = rows.withColumns({"_source": _key("source"), "_size": F.col("size"), "_part": part}).withColumn("_place", place)
    copies = F.col("_least") + F.expr("(_first + _place) * _more div n - (_first + _place - 1) * _more div n")
    return placed.join(dealt, keys).select(*rows.columns, "source_size", "target", copies.alias("copies"))


def op6_entropy_mixing(documents: DataFrame) -> DataFrame:
    """Words the mix takes of each row; null texts have size 0 and give none, null sources come last, repeated rows count each,
    an empty table gives an empty table."""
    return mix_sources(documents, ["doc_id", "source"]).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
