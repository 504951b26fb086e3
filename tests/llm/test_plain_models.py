"""The two solvers against plain versions of what they solve."""

import numpy as np

from tidewatch.llm import mixing, quality_classifier as fm


def test_interaction_is_the_sum_over_all_pairs():
    draw = np.random.default_rng(5)
    bias, linear, factors = 0.3, draw.normal(size=fm.N_FEATURES), draw.normal(size=(fm.N_FEATURES, fm.RANK))
    lengths = [1, 2, 7, 40]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    index, value = draw.integers(0, fm.N_FEATURES, bounds[-1]), draw.normal(size=bounds[-1])
    index[4] = index[5]  # one feature twice
    got, sums = fm.interaction((bias, linear, factors), index, value, bounds)
    for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        plain = bias + sum(linear[index[i]] * value[i] for i in range(a, b))
        plain += sum(factors[index[i]] @ factors[index[j]] * value[i] * value[j] for i in range(a, b) for j in range(i + 1, b))
        assert abs(got[row] - plain) < 1e-8 * max(1, abs(plain))
        assert np.allclose(sums[row], sum(factors[index[i]] * value[i] for i in range(a, b)))


def test_tilts_solve_the_dual(prepared):
    """Rates meet the words wanted, and no other rates that do are nearer to one copy of each document."""
    draw = np.random.default_rng(9)
    sizes = {name: np.unique(draw.integers(1, top, 30)) for name, top in (("a", 50), ("b", 4000), (None, 9))}
    counts = {name: draw.integers(1, 40, len(v)) for name, v in sizes.items()}
    wanted = {"a": 0.4, "b": 1.7, None: 1.0}
    rows = [(name, int(s), int(n)) for name in sizes for s, n in zip(sizes[name], counts[name])]
    total = {name: int((sizes[name] * counts[name]).sum()) for name in sizes}
    targets = [(name, total[name], share * total[name]) for name, share in wanted.items()]
    found = mixing.tilts(prepared.createDataFrame(rows, "source string, size long, n long"),
                         prepared.createDataFrame(targets, "source string, source_size long, target double")).collect()
    assert len(found) == 3
    for r in found:
        size, n, target = sizes[r["source"]], counts[r["source"]], wanted[r["source"]] * total[r["source"]]

        def rates(tilt):
            return np.minimum(mixing.LIMIT, np.exp(np.minimum(tilt * size / r["scale"], np.log(mixing.LIMIT))))

        low, high = -50.0, 50.0
        for _ in range(200):  # the words taken grow with the tilt
            middle = (low + high) / 2
            low, high = (middle, high) if (size * n * rates(middle)).sum() < target else (low, middle)
        assert abs(r["tilt"] - low) < 1e-6
        rate = rates(r["tilt"])
        assert abs((size * n * rate).sum() - target) < 1e-6 * target

        def distance(x):
            return (n * (x * np.log(x) - x + 1)).sum()

        for _ in range(200):
            step = draw.normal(size=len(size)) * 1e-3
            step -= (step * size * n).sum() / (size * n * size * n).sum() * size * n  # the same words are taken
            other = rate + step
            if other.min() > 0 and other.max() <= mixing.LIMIT:
                assert distance(other) >= distance(rate) - 1e-9
