"""The minimum covariance determinant of each group against a plain version with exact order and many random starts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import quality_rules as rules

P = rules.P


def estimate(rows, prior):
    n, means = len(rows), np.concatenate([rows.mean(0), [(rows[:, i] * rows[:, j]).mean() for i, j in rules._PAIRS]])
    if prior is not None:
        means = (n * means + rules.PRIOR * prior) / (n + rules.PRIOR)
    cov = np.zeros((P, P))
    for (i, j), value in zip(rules._PAIRS, means[P:]):
        cov[i, j] = cov[j, i] = value - means[i] * means[j]
    return means, rules.WIDEN * cov + np.diag(np.square(rules.FLOORS))


def distances(rows, means, cov):
    d = rows - means[:P]
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def plain(rows, prior, draw):
    """Smallest log determinant of all starts, its means and covariance."""
    best = None
    keep = int(np.ceil(rules.SHARE * len(rows)))
    for start in range(30):
        some = rows if not start else rows[draw.choice(len(rows), min(len(rows), P + 1), replace=False)]
        means, cov = estimate(some, prior)
        for _ in range(100):
            near = np.argsort(distances(rows, means, cov), kind="stable")[:keep]
            means, cov = estimate(rows[near], prior)
        found = np.linalg.slogdet(cov)[1], means, cov
        best = found if best is None or found[0] < best[0] else best
    return best


@pytest.fixture(scope="module")
def groups():
    """Groups of all sizes; of a large one 20 % lie in a far cluster, which draws mean and covariance of the whole."""
    draw = np.random.default_rng(7)
    mixing = np.eye(P) + 0.5 * draw.normal(size=(P, P))
    out = {}
    for name, size in (("large", 900), ("middle", 200), ("small", 12), ("pair", 2), ("lone", 1)):
        rows = draw.normal(size=(size, P)) @ mixing + (2 if name == "small" else 0)
        far = size // 5 if name == "large" else size // 50
        rows[:far] = draw.normal(size=(far, P)) * 0.3 + 40
        out[name] = rows
    return out


def test_against_plain(prepared, groups):
    frame = prepared.createDataFrame([(name, k, *map(float, row)) for name, rows in groups.items() for k, row in enumerate(rows)],
                                     f"lang string, k long, {', '.join(f'x{i} double' for i in range(P))}")
    found = rules.outliers(frame, ["lang"], [F.col(f"x{i}") for i in range(P)])
    assert sorted(found.columns) == sorted([*frame.columns, "distance"])
    got = {(r["lang"], r["k"]): r["distance"] for r in found.collect()}
    assert len(got) == sum(map(len, groups.values()))
    draw = np.random.default_rng(1)
    _, prior, _ = plain(np.concatenate(list(groups.values())), None, draw)
    for name, rows in groups.items():
        _, means, cov = plain(rows, prior, draw)
        expected = distances(rows, means, cov)
        mine = np.array([got[name, k] for k in range(len(rows))])
        assert ((mine > rules.CUTOFF) == (expected > rules.CUTOFF)).all(), name
        assert np.abs(np.log(mine / expected)).max() < 0.25, name


def test_each_measure_can_reject_alone():
    """In rows that are else alike, the extreme of each measure exceeds the cutoff."""
    extremes = np.log1p([1e5, 50, 1000, 100, 100]) - np.log1p([300, 5, 0, 0, 0])
    assert (np.square(extremes / rules.FLOORS) > rules.CUTOFF).all()


def test_steps_end_on_equal_and_few_rows(prepared):
    frame = prepared.createDataFrame([("a", 1.0)] * 50 + [("b", 9.0), (None, 1.0)], "lang string, x double")
    found = rules.outliers(frame, ["lang"], [F.col("x")] * P).collect()
    assert len(found) == 52 and all(r["distance"] < 1e-6 for r in found if r["lang"] == "a")
    assert all(r["distance"] is not None for r in found)
    assert rules.outliers(frame.limit(0), ["lang"], [F.col("x")] * P).count() == 0
