"""Multi-seasonal decomposition of one short series, one step ahead.

STL after Cleveland et al. (1990), several seasons after Bandara, Hyndman and
Bergmeir (2021), exponential smoothing of the seasonally adjusted series.
Used inside tasks by the ``mstl`` forecast; numpy only.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Smoothing windows of the 1st, 2nd, ... season, outer and inner passes.
_FIRST_SEASON_WINDOW, _SEASON_WINDOW_STEP = 11, 4
_OUTER_PASSES, _INNER_PASSES = 2, 2


@lru_cache(maxsize=512)
def _loess_weights(size: int, span: int, degree: int, step: int, extend: int) -> tuple:
    """Evaluation points, start of their neighbourhoods, and weights.

    Points are equally spaced, so the weights do not depend on the data and a
    local regression is a weighted sum of the neighbourhood.
    """
    width = min(span, size)
    points = np.arange(0, size, step, dtype=float)
    if points[-1] != size - 1:
        points = np.append(points, size - 1.0)
    if extend:
        points = np.concatenate([[-1.0], points, [float(size)]])
    left = np.clip(np.round(points).astype(int) - (width - 1) // 2, 0, size - width)
    places = left[:, None] + np.arange(width)
    distance = np.abs(places - points[:, None])
    reach = np.maximum(points - left, left + width - 1 - points) + max(0, (span - size) // 2)
    reach = np.maximum(reach, 1e-9)[:, None]
    weights = np.where(distance <= 0.999 * reach, (1 - (distance / reach) ** 3) ** 3, 0.0)
    weights = np.where(distance <= 0.001 * reach, 1.0, weights)
    weights /= weights.sum(axis=1, keepdims=True)
    if degree:
        centre = (weights * places).sum(axis=1, keepdims=True)
        spread = (weights * (places - centre) ** 2).sum(axis=1, keepdims=True)
        slope = np.where(np.sqrt(spread) > 0.001 * (size - 1), (points[:, None] - centre) / np.maximum(spread, 1e-12), 0)
        weights = weights * (slope * (places - centre) + 1)
    return points, places, weights


def _smooth(values: np.ndarray, span: int, degree: int, extend: int = 0) -> np.ndarray:
    """Loess along axis 0, evaluated at every tenth of the span and interpolated."""
    size = values.shape[0]
    step = max(1, -(-span // 10))
    points, places, weights = _loess_weights(size, span, degree, min(step, size), extend)
    fitted = np.einsum("pw,pw...->p...", weights, values[places])
    wanted = np.arange(-extend, size + extend, dtype=float)
    if len(points) == len(wanted):
        return fitted
    if fitted.ndim == 1:
        return np.interp(wanted, points, fitted)
    return np.stack([np.interp(wanted, points, column) for column in fitted.T], axis=1)


def _moving_average(values: np.ndarray, length: int) -> np.ndarray:
    total = np.cumsum(np.insert(values, 0, 0.0))
    return (total[length:] - total[:-length]) / length


def _odd(number: float) -> int:
    whole = int(np.ceil(number))
    return whole if whole % 2 else whole + 1


def _stl(values: np.ndarray, period: int, window: int) -> np.ndarray:
    """Seasonal component of one period."""
    size = len(values)
    trend_span = _odd(1.5 * period / (1 - 1.5 / window))
    trend = np.zeros(size)
    for _ in range(_INNER_PASSES):
        detrended = values - trend
        cycle = np.empty(size + 2 * period)
        # Only two lengths of cycle-subseries occur: smooth each kind in one go.
        full, rest = divmod(size, period)
        for first, last, count in ((0, rest, full + 1), (rest, period, full)):
            if first == last:
                continue
            places = np.arange(first, last)[None, :] + period * np.arange(count)[:, None]
            smoothed = _smooth(detrended[places], window, 0, extend=1)
            cycle[np.arange(first, last)[None, :] + period * np.arange(count + 2)[:, None]] = smoothed
        low = _moving_average(_moving_average(_moving_average(cycle, period), period), 3)
        seasonal = cycle[period:period + size] - _smooth(low, _odd(period), 1)
        trend = _smooth(values - seasonal, trend_span, 1)
    return seasonal


def _next_level(values: np.ndarray) -> float:
    """One step ahead by exponential smoothing, with or without a trend, by AICc.

    All candidate parameters are tried at once: the recursion runs over time,
    the vector over candidates.
    """
    size = len(values)
    if size < 6:
        return float(values[-1])
    alphas = np.array([0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99])
    alpha, ratio = (grid.ravel() for grid in np.meshgrid(alphas, [0.0, 0.01, 0.05, 0.15, 0.4]))
    beta, trended = alpha * ratio, ratio > 0
    head = values[:min(size, 10)]
    slope = np.polyfit(np.arange(len(head)), head, 1)[0]
    level = np.where(trended, head[0] - slope, head.mean())
    trend = np.where(trended, slope, 0.0)
    error = np.zeros(len(alpha))
    for value in values:
        miss = value - level - trend
        error += miss * miss
        level = level + trend + alpha * miss
        trend = trend + beta * miss
    used = np.where(trended, 5, 3)
    score = size * np.log(np.maximum(error / size, 1e-300)) + 2 * used + 2 * used * (used + 1) / max(size - 6, 1)
    best = int(np.argmin(score))
    return float(level[best] + trend[best])


def next_value(values: np.ndarray, seasons: list[float]) -> float:
    """Forecast of the value after the last one."""
    values = np.asarray(values, dtype=float)
    size = len(values)
    periods = sorted(int(season) for season in seasons if 2 <= season < size / 2)
    seasonal = [np.zeros(size) for _ in periods]
    adjusted = values.copy()
    for _ in range(_OUTER_PASSES):
        for index, period in enumerate(periods):
            adjusted = adjusted + seasonal[index]
            window = _FIRST_SEASON_WINDOW + _SEASON_WINDOW_STEP * index
            seasonal[index] = _stl(adjusted, period, window)
            adjusted = adjusted - seasonal[index]
        if len(periods) < 2:
            break
    return _next_level(adjusted) + float(sum(part[size - period] for part, period in zip(seasonal, periods)))
