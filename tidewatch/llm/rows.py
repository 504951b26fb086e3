"""Row numbers and connected components without a global sort in one task or a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.session import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in these bits


def numbered(frame: DataFrame, order: list, label: str, weight: str | None = None) -> DataFrame:
    """``frame`` with ``row_number`` from 0 in the given order; ``before`` sums ``weight`` over the rows before.

    Rows are dealt into ranges of the order, sorted there and stored; the count of each range shifts the numbers of the next.
    Equal rows may be cut apart by a range border, so that a value which many rows share does not fill one range.
    What is broadcast has one row for each partition.
    """
    at = F.monotonically_increasing_id()
    dealt = frame.withColumn("_tie", at).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    kept = stored(dealt.drop("_tie").withColumn("_at", at), label)
    part = F.shiftright("_at", _ROW_BITS)
    sums = [F.count(F.lit(1)).alias("_rows")] + ([F.sum(weight).alias("_weight")] if weight else [])
    parts = kept.groupBy(part.alias("_part")).agg(*sums)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"),
                         *([F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_sum")] if weight else []))
    rows = kept.withColumn("_part", part).join(F.broadcast(shift), "_part")
    number = F.col("_first") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    if weight:
        within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.col("_sum") + F.coalesce(F.sum(weight).over(within), F.lit(0)))
        rows = rows.drop("_sum")
    return rows.withColumn("row_number", number).drop("_part", "_first", "_at")


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` of the nodes of ``edges`` (``a``, ``b``): the smallest node that each one reaches.

    Alternates the two star steps (connect larger neighbours, then smaller ones, to the smallest) until nothing changes.
    The table of a step is stored; only its size and checksum reach the driver.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, mark = None, None
    while True:
        pairs = stored(pairs, label)
        new = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b"))).first()
        if new == mark or not new[0]:
            break
        state, mark = pairs, new
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("b"))
        small = large.join(low.withColumnRenamed("b", "m"), "a").filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = low.unionByName(small).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
