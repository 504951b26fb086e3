"""Reproducible shuffle into shards by a permutation of row numbers that can be computed for any single row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.rows import numbered

ROUNDS = 6
WALK = 256  # steps along a cycle; more than any walk can have below 65,536 rows, and beyond all odds above


def _div(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def _whole(value: int) -> Column:
    return F.lit(value).cast("long")


def halves(n: int) -> tuple[int, int]:
    """Two factors whose product is at least ``n`` and exceeds it by less than the first."""
    a = max(int(n ** 0.5), 1)
    while a * a < n:
        a += 1
    return a, max(-(-n // a), 1)


def _network(x: Column, n: int, seed: int, inverse: bool) -> Column:
    """One pass of a Feistel network whose halves are numbers below ``a`` and below ``b``; they take turns."""
    a, b = (_whole(v) for v in halves(n))
    order = range(ROUNDS)[::-1] if inverse else range(ROUNDS)
    sign = -1 if inverse else 1

    def turn(state: Column, k: Column) -> Column:
        even = k % 2 == 0
        value = F.xxhash64(F.when(even, state["r"]).otherwise(state["l"]), k + _whole(seed * 1000))
        left = F.when(even, F.pmod(state["l"] + F.pmod(value, a) * sign, a)).otherwise(state["l"])
        right = F.when(even, state["r"]).otherwise(F.pmod(state["r"] + F.pmod(value, b) * sign, b))
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(_div(x, b).alias("l"), F.pmod(x, b).alias("r"))
    return F.aggregate(F.array(*[_whole(k) for k in order]), start, turn, lambda s: s["l"] * b + s["r"])


def permuted(number: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """The place of row ``number`` (below ``n``) in the shuffle; ``inverse``: the row at a place.

    The network permutes a range that exceeds ``n`` by less than its root; a value outside walks on along its cycle
    until it is inside.
    """
    limit = _whole(n)
    once = _network(number, n, seed, inverse)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once,
                         lambda x, _: F.when(x < limit, x).otherwise(_network(x, n, seed, inverse)),
                         lambda x: F.when(x < limit, x).otherwise(F.raise_error(F.lit("walk too long")).cast("long")))
    return F.when(once < limit, once).otherwise(walked)


def shard_rows(rows: DataFrame, order: list[str], shards: int, seed: int = 1) -> DataFrame:
    """``rows`` with ``row_number`` (by ``order``), ``shard`` and ``slot``: shuffled, counts of shards at most one apart.

    A row's place is computed from its number alone, and ``permuted(place, n, seed, inverse=True)`` gives the number back,
    so any shard and slot can be found without the table.  Rows that are equal in ``order`` are numbered in any order.
    An empty table gives an empty table; columns of ``rows`` called like the added ones are replaced.
    """
    clash = [c for c in rows.columns if c.lower() in ("row_number", "shard", "slot")]
    by_number = numbered(rows.drop(*clash), order, "shards")
    n = by_number.count()
    place = permuted(F.col("row_number"), max(n, 1), seed)
    return (by_number.withColumn("_place", place)
            .withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int"))
            .withColumn("slot", _div(F.col("_place"), _whole(shards))).drop("_place"))


def op5_feistel_sharding(documents: DataFrame, shards: int = 16, seed: int = 1) -> DataFrame:
    """Deal documents by ``doc_id`` (null first), then by text checksum and size; a null text has size 1 and checksum 0."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                            F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(rows, ["doc_id", "text_crc32", "size"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
