"""Quality rules: counts over whole texts, and robust outliers of each language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.llm.text import mix, range_hashes, slices, windows, word_spans
from tidewatch.session import stored

MIN_WORDS = 10
WINDOW = 5
REPEATED_PERCENT = 20
SHARE = 0.75  # of a group's rows that the determinant is taken over
PRIOR = 40  # rows of the whole table's kind that every group is estimated with
STILL = 1e-4  # what the logarithm of a determinant has to fall by, or its steps end
LANES = 16
# Fixed values for five measures: the 0.999999 quantile of chi-square, and the factor that makes the covariance of the
# central 75 % of a normal sample that of the whole.
CUTOFF, WIDEN = 35.9, 1.41
# Spread that each transformed measure is granted at least, so that a measure which is the same in nearly all rows
# does not turn small differences into outliers.
FLOORS = (0.4, 0.1, 0.6, 0.5, 0.5)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SALT = np.uint64(0xA24BAED4963EE407)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _rows_of(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of ``COUNTS`` for each row of a slice."""
    rows = len(offsets) - 1
    starts, ends, firsts = word_spans(data, offsets)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    np.subtract.at(in_word, ends, 1)
    inside = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    n_words = np.diff(firsts)

    line_ends = np.flatnonzero(data == 10)
    line_from = np.union1d(offsets[:-1], line_ends + 1)
    line_from = line_from[line_from < len(data)]
    line_to = np.append(line_from[1:], len(data))[:len(line_from)]
    line_to = line_to - (data[line_to - 1] == 10)
    worded = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_from)
    line_from, line_to = line_from[worded], line_to[worded]
    line_row = np.searchsorted(offsets, line_from, "right") - 1
    keys = mix(range_hashes(data, line_from, line_to) + line_row.astype(np.uint64) * _SALT)
    fresh = np.unique(keys, return_index=True)[1]
    n_dup = np.bincount(line_row, minlength=rows) - np.bincount(line_row[fresh], minlength=rows)

    words = range_hashes(data, starts, ends)
    grams = windows(words, WINDOW)
    word_row = _rows_of(firsts)
    covered = np.zeros(len(words), bool)
    if len(grams):
        valid = np.flatnonzero(word_row[:len(grams)] == word_row[WINDOW - 1:])
        keys = mix(grams[valid] + word_row[valid].astype(np.uint64) * _SALT)
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(valid), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for k in range(WINDOW):
            covered[valid[again] + k] = True
    return {"n_words": n_words, "word_chars": _per_row(inside & ((data & 0xC0) != 0x80), offsets),
            "n_symbols": _per_row(_SYMBOL[data], offsets), "n_dup_lines": n_dup,
            "n_repeat_words": _per_row(covered, firsts)}


def _counted(position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [text_counts(data, offsets) for _, data, offsets in slices(batch.column(position))]
            added = [pa.array(np.concatenate([p[name] for p in parts]) if parts else [], pa.int64()) for name in COUNTS]
            kept = [batch.column(k) for k in range(batch.num_columns) if k != position]
            names = [n for k, n in enumerate(batch.schema.names) if k != position]
            yield pa.RecordBatch.from_arrays([*kept, *added], [*names, *COUNTS])
    return run


def with_counts(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the counts of each document's text; a null text has no words."""
    rows = documents.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, T.LongType(), False) for c in COUNTS]])
    return rows.mapInArrow(_counted(len(keep)), schema)


def measures() -> list[Column]:
    """The counts, set to one scale: sizes as logarithms, the others as logarithms of a share."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [F.log1p("n_words"), F.log1p(chars / words), F.log1p(1000 * F.col("n_symbols") / chars),
            F.log1p(100 * F.col("n_dup_lines") / words), F.log1p(100 * F.col("n_repeat_words") / words)]


P = len(FLOORS)
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_FIT = T.ArrayType(T.DoubleType())


def _solve(prior: list[float] | None):
    """Centre, inverse covariance and log determinant of each group from its sums, and their means.

    ``prior`` holds such means; they count as PRIOR rows more.  So a group of a few rows has the spread of the prior, and
    what lies between the two centres; in a large group the prior does not show.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(float)
            sums = np.array(batch.column("sums").to_pylist(), float).reshape(len(n), -1)
            if prior is not None:
                n, sums = n + PRIOR, sums + PRIOR * np.array(prior)
            means = sums / n[:, None]
            fits = []
            for row in means:
                centre = row[:P]
                cov = np.zeros((P, P))
                for (i, j), value in zip(_PAIRS, row[P:]):
                    cov[i, j] = cov[j, i] = value - centre[i] * centre[j]
                cov = cov * WIDEN
                cov[np.diag_indices(P)] += np.square(FLOORS)
                inverse = np.linalg.inv(cov)
                fits.append([*centre, *(inverse[i, j] * (1 if i == j else 2) for i, j in _PAIRS), np.linalg.slogdet(cov)[1]])
            numbers = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("start"), pa.array(fits, numbers),
                                              pa.array(means.tolist(), numbers)], ["grp", "start", "fit", "means"])
    return run


def _distance(x: Column, fit: Column) -> Column:
    """Squared Mahalanobis distance, written out."""
    d = [x[k] - fit[k] for k in range(P)]
    total = F.lit(0.0)
    for n, (i, j) in enumerate(_PAIRS):
        total = total + fit[P + n] * d[i] * d[j]
    return total


def _sums(x: Column) -> list[Column]:
    return [F.sum(x[k]) for k in range(P)] + [F.sum(x[i] * x[j]) for i, j in _PAIRS]


_FITS = T.StructType([T.StructField("grp", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("fit", _FIT), T.StructField("means", _FIT)])


def _met(base: DataFrame, fits: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the fits of their group; a large group is met in ``LANES`` parts."""
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    return base.join(fits.withColumn("_lane", lanes), ["grp", "_lane"], how)


def _step(base: DataFrame, fits: DataFrame, prior: list[float] | None) -> DataFrame:
    """A concentration step: the nearest ``SHARE`` of each group's rows, estimated anew."""
    x = F.col("_x")
    near = _met(base, fits).withColumn("_bin", F.round(
        64 * F.log2(F.greatest(_distance(x, F.col("fit")), F.lit(1e-9)))).cast("int"))
    bins = near.groupBy("grp", "start", "_bin").agg(F.count(F.lit(1)).alias("n"), *[
        s.alias(f"_s{k}") for k, s in enumerate(_sums(x))])
    up_to = Window.partitionBy("grp", "start").orderBy("_bin")
    all_ = Window.partitionBy("grp", "start")
    inner = bins.withColumn("_before", F.sum("n").over(up_to) - F.col("n")).withColumn("_all", F.sum("n").over(all_))
    inner = inner.filter(F.col("_before") < F.col("_all") * SHARE)
    sums = inner.groupBy("grp", "start").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(f"_s{k}") for k in range(P + len(_PAIRS))]).alias("sums"))
    return sums.mapInArrow(_solve(prior), _FITS)


def concentrated(base: DataFrame, prior: list[float] | None) -> DataFrame:
    """``(grp, fit, means)``: of the rows of each group, the estimate of the ``SHARE`` with the smallest determinant.

    From two starts, the whole group and its coordinatewise medians, steps go on until no determinant falls; a start that
    stands still takes no part in the next step.  Which rows are nearest is read from exact counts of finely binned
    distances, so a step is one aggregation, combined before it is shuffled.
    """
    x = F.col("_x")
    first = stored(base.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.array(*_sums(x)).alias("sums"),
        *[F.percentile_approx(x[k], 0.5, 1000).alias(f"_m{k}") for k in range(P)]), "first")
    whole = first.select("grp", F.lit(0).alias("start"), "n", "sums").mapInArrow(_solve(prior), _FITS)
    middle = first.select("grp", F.lit(1).alias("start"), F.array(
        *[F.col(f"_m{k}") for k in range(P)], *[F.lit(1.0 / f ** 2 if i == j else 0.0) for i, j in _PAIRS for f in [FLOORS[i]]],
        F.lit(0.0)).alias("fit"), F.array().cast(_FIT).alias("means"))
    det, new_det = F.col("_det"), F.col("_fit")[P + len(_PAIRS)]
    state = whole.unionByName(middle).withColumns({"_det": F.lit(1e300), "_open": F.lit(True)})
    while True:
        state = stored(state, "fits")
        if not state.filter("_open").head(1):
            break
        moved = _step(base, state.filter("_open").select("grp", "start", "fit"), prior).select(
            "grp", "start", F.col("fit").alias("_fit"), F.col("means").alias("_means"))
        fell = F.coalesce(new_det < det - STILL, F.lit(False))
        state = state.join(moved, ["grp", "start"], "left").select(
            "grp", "start", F.when(fell, F.col("_fit")).otherwise(F.col("fit")).alias("fit"),
            F.when(fell, F.col("_means")).otherwise(F.col("means")).alias("means"),
            F.when(fell, new_det).otherwise(det).alias("_det"), fell.alias("_open"))
    best = F.struct(F.col("_det"), F.col("start"))
    return state.groupBy("grp").agg(F.min_by("fit", best).alias("fit"), F.min_by("means", best).alias("means"))


def outliers(rows: DataFrame, group: list[str], x: list[Column]) -> DataFrame:
    """``rows`` with ``distance``, squared, from the robust centre of their group.

    Each group's centre and covariance are those of ``concentrated``, estimated with PRIOR rows of what the same
    estimate gives for the whole table: groups of all sizes are judged alike, and one of a few rows mostly by the whole table.
    """
    key = F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in group]))
    base = stored(rows.withColumn("_x", F.array(*x)).withColumn("grp", key)
                  .withColumn("_lane", F.pmod(F.monotonically_increasing_id(), F.lit(LANES)).cast("int")), "measured")
    whole = concentrated(base.select(F.lit("").alias("grp"), "_lane", "_x"), None).select("means").first()
    best = concentrated(base.select("grp", "_lane", "_x"), list(whole[0]) if whole else None).drop("means")
    found = _met(base, best, "left")
    return found.withColumn("distance", _distance(F.col("_x"), F.col("fit"))).drop("_x", "_lane", "grp", "fit")


def quality_rules(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, counts, ``base_failed``, ``distance`` and ``kept``.

    A document fails the base rule with under ``MIN_WORDS`` words or with over ``REPEATED_PERCENT`` percent of its words in
    repeated windows; else it is kept unless its distance exceeds ``CUTOFF``.  Null languages and sources are groups of
    their own; a null or empty text fails.  Repeated rows count each.
    """
    grouped = [F.col(c).alias(f"_g_{c}") for c in ("lang", "source")]
    rows = with_counts(documents.select(*keep, *grouped, "text"), [*keep, "_g_lang", "_g_source"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    judged = outliers(rows, ["_g_lang", "_g_source"], measures())
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & ~F.coalesce(F.col("distance") > CUTOFF, F.lit(False))).drop("_g_lang", "_g_source")


def op2_mcd_quality(documents: DataFrame) -> DataFrame:
    """Counts and verdict of each row; a null text has no words and fails, null languages and sources are groups of their own,
    repeated rows are counted each, an empty table gives an empty table."""
    return quality_rules(documents, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
