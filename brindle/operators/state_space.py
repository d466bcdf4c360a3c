"""Exact likelihood of seasonal autoregressive moving-average models by a Kalman recursion, for many parameter vectors at a time.

The gradient, the line search and all of a fit's trial points are rows of one batch, so the series is passed once for each of them
together.  Parameters are free numbers that are mapped to partial autocorrelations, which keeps every model stationary and invertible.
"""

from __future__ import annotations

import numpy as np

Order = tuple[int, int, int]


def from_partial(x: np.ndarray) -> np.ndarray:
    """Rows of free numbers to rows of coefficients whose polynomial has all roots outside the unit circle."""
    r = np.tanh(x)
    out = np.zeros((len(x), 0))
    for k in range(x.shape[1]):
        out = np.hstack([out - r[:, k : k + 1] * out[:, ::-1], r[:, k : k + 1]])
    return out


def _product(short: np.ndarray, seasonal: np.ndarray, m: int, sign: float) -> np.ndarray:
    """Coefficients of the product of (1 + sign·Σ aL^i) and (1 + sign·Σ bL^(m·j)), less the leading one, times sign."""
    n = short.shape[1] + m * seasonal.shape[1]
    out = np.zeros((len(short), n + 1))
    a = np.hstack([np.ones((len(short), 1)), sign * short])
    for j in range(seasonal.shape[1] + 1):
        b = np.ones(len(short)) if j == 0 else sign * seasonal[:, j - 1]
        out[:, j * m : j * m + a.shape[1]] += b[:, None] * a
    return sign * out[:, 1:]


def polynomials(x: np.ndarray, order: Order, seasonal: Order, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of free numbers to (autoregressive, moving-average) coefficients, seasonal factors multiplied in."""
    sizes = np.cumsum([order[0], order[2], seasonal[0], seasonal[2]])
    p, q, sp, sq = (from_partial(part) for part in np.split(x, sizes[:-1], axis=1))
    return _product(p, sp, m, -1.0), _product(q, sq, m, 1.0)


def kalman(z: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-likelihood with the variance concentrated out, variance, state behind the last value) of each row of coefficients."""
    size, n = len(ar), len(z)
    r = max(ar.shape[1], ma.shape[1] + 1, 1)
    phi, load = np.zeros((size, r)), np.zeros((size, r))
    phi[:, : ar.shape[1]], load[:, 0], load[:, 1 : ma.shape[1] + 1] = ar, 1.0, ma
    move = np.zeros((size, r, r))
    move[:, :, 0] = phi
    move[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    noise = load[:, :, None] * load[:, None, :]
    # stationary covariance by doubling
    cov, step = noise.copy(), move.copy()
    for _ in range(40):
        more = step @ cov @ step.transpose(0, 2, 1)
        cov = cov + more
        if not np.isfinite(more).all() or np.abs(more).max() <= 1e-12 * np.abs(cov).max():
            break
        step = step @ step
    state, logs, squares, gain, still = np.zeros((size, r)), np.zeros(size), np.zeros(size), None, False
    with np.errstate(all="ignore"):
        for value in z:
            off = value - state[:, 0]
            if not still:
                f = cov[:, 0, 0]
                column = (move @ cov[:, :, :1])[:, :, 0]
                gain = column / f[:, None]
                cov = move @ cov @ move.transpose(0, 2, 1) + noise - gain[:, :, None] * column[:, None, :]
                still = bool(np.all(np.abs(f - 1) < 1e-8))
            logs += np.log(f)
            squares += off**2 / f
            state = phi * state[:, :1] + np.hstack([state[:, 1:], np.zeros((size, 1))]) + gain * off[:, None]
        variance = squares / n
        value = -0.5 * (n * (np.log(2 * np.pi * variance) + 1) + logs)
    return np.where(np.isfinite(value), value, -np.inf), variance, state


def maximise(z: np.ndarray, order: Order, seasonal: Order, m: int, rounds: int = 60) -> tuple[float, np.ndarray]:
    """(log-likelihood, free numbers) by quasi-Newton steps with central differences."""
    k = order[0] + order[2] + seasonal[0] + seasonal[2]

    def cost(points: np.ndarray) -> np.ndarray:
        return -kalman(z, *polynomials(points, order, seasonal, m))[0]

    x = np.full(k, 0.1)
    best = cost(x[None])[0]
    if not k:
        return -best, x
    inverse, slope_before, x_before = np.eye(k), None, None
    for _ in range(rounds):
        h = 1e-5
        around = cost(np.vstack([x + h * np.eye(k), x - h * np.eye(k)]))
        slope = (around[:k] - around[k:]) / (2 * h)
        if not np.isfinite(slope).all() or np.abs(slope).max() < 1e-5 * max(1.0, abs(best)) ** 0.5:
            break
        if slope_before is not None:
            s, y = x - x_before, slope - slope_before
            if (sy := s @ y) > 1e-12:
                a = np.eye(k) - np.outer(s, y) / sy
                inverse = a @ inverse @ a.T + np.outer(s, s) / sy
        way = -inverse @ slope
        way *= min(1.0, 1.5 / np.abs(way).max())
        tried = x + np.outer(0.5 ** np.arange(12), way)
        found = cost(tried)
        at = int(np.argmin(found))
        if not found[at] < best - 1e-9:
            if slope_before is None or np.allclose(inverse, np.eye(k)):
                break
            inverse, slope_before = np.eye(k), None  # once more along the slope itself
            continue
        gained, x_before, slope_before, x, best = best - found[at], x, slope, tried[at], found[at]
        if gained < 1e-5:
            break
    return -best, x


def differenced(values: np.ndarray, d: int, sd: int, m: int) -> list[np.ndarray]:
    """The series, and what is left after each difference: the seasonal ones first."""
    levels = [np.asarray(values, dtype=float)]
    for s in [m] * sd + [1] * d:
        levels.append(levels[-1][s:] - levels[-1][:-s])
    return levels


def stationarity(z: np.ndarray) -> float:
    """The statistic whose large values speak against a level series (its 5 % point is 0.463), with Bartlett weights."""
    e = z - z.mean()
    n, lags = len(e), int(np.ceil(12 * (len(e) / 100) ** 0.25))
    long = e @ e / n + sum(2 * (1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / n for k in range(1, min(lags, n - 1) + 1))
    return float((np.cumsum(e) ** 2).sum() / n**2 / long) if long > 0 else 0.0


def choose_differences(values: np.ndarray, m: int) -> tuple[int, int]:
    """(d, D): a seasonal difference where the season carries most of the variance, plain ones until the series is level."""
    y = np.asarray(values, dtype=float)
    sd = 0
    if m > 1 and len(y) >= 3 * m:
        trend = np.convolve(y, np.ones(m) / m, mode="valid")
        rest = y[m // 2 : m // 2 + len(trend)] - trend
        season = np.array([rest[i::m].mean() for i in range(m)])
        left = rest - season[np.arange(len(rest)) % m]
        sd = int(rest.var() > 0 and 1 - left.var() / rest.var() > 0.64)
    d = 0
    while d < 2 and len(y) > m * sd + d + 10 and stationarity(differenced(y, d, sd, m)[-1]) > 0.463:
        d += 1
    return d, sd


def fit_sarima(values: np.ndarray, order: Order, seasonal: Order, m: int, h: int = 0) -> dict:
    """aic, coefficients and, for h steps, yhat and the half width of the 95 % band.  Without a difference the mean is taken out first.

    Too short a series for its differences has an infinite aic and no forecasts.
    """
    (p, d, q), (sp, sd, sq) = order, seasonal
    if len(values) <= d + m * sd + 2:
        return {"aic": np.inf, "yhat": np.full(h, np.nan), "spread": np.full(h, np.nan), "ar": np.zeros(0), "ma": np.zeros(0), "sigma2": np.nan}
    levels = differenced(values, d, sd, m)
    mean = 0.0 if d + sd else levels[-1].mean()
    z = levels[-1] - mean
    fitted, x = maximise(z, order, seasonal, m)
    ar, ma = polynomials(x[None], order, seasonal, m)
    _, variance, state = kalman(z, ar, ma)
    ar, ma, state, sigma2 = ar[0], ma[0], state[0].copy(), float(variance[0])
    out = {"aic": 2 * (len(x) + 1 + (d + sd == 0)) - 2 * fitted, "ar": ar, "ma": ma, "sigma2": sigma2, "loglik": fitted}
    path = np.zeros(h)
    for i in range(h):
        path[i] = state[0]
        lead = state[0]
        state = np.append(state[1:], 0.0)
        state[: len(ar)] += ar * lead
    path += mean
    steps = [m] * sd + [1] * d
    for s, level in zip(reversed(steps), reversed(levels[:-1])):
        history = list(level[-s:])
        for v in path:
            history.append(v + history[-s])
        path = np.array(history[s:])
    poly = np.concatenate([[1.0], -ar])
    for s in steps:
        poly = np.convolve(poly, np.concatenate([[1.0], np.zeros(s - 1), [-1.0]]))
    psi = np.zeros(h)
    for i in range(h):
        psi[i] = (1.0 if i == 0 else ma[i - 1] if i <= len(ma) else 0.0) - sum(poly[j] * psi[i - j] for j in range(1, min(i, len(poly) - 1) + 1))
    return out | {"yhat": path, "spread": 1.96 * np.sqrt(sigma2 * np.cumsum(psi**2))}


def stepwise(values: np.ndarray, m: int, most: tuple[int, int, int, int] = (3, 3, 2, 2)) -> list[tuple[Order, Order, float]]:
    """(order, seasonal order, aic) of every model looked at, the best first: from four starts to better neighbours until none is."""
    d, sd = choose_differences(values, m)
    seen: dict[tuple[int, int, int, int], float] = {}

    def aic(c: tuple[int, int, int, int]) -> float:
        if c not in seen:
            seen[c] = fit_sarima(values, (c[0], d, c[1]), (c[2], sd, c[3]), m)["aic"]
        return seen[c]

    starts = [(2, 2, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1)]
    at = min((tuple(min(a, b) for a, b in zip(s, most)) for s in starts), key=aic)
    moves = [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (1, 1, 0, 0), (0, 0, 1, 1)]
    while True:
        near = [tuple(a + s * b for a, b in zip(at, move)) for move in moves for s in (-1, 1)]
        better = next((c for c in near if all(0 <= a <= b for a, b in zip(c, most)) and aic(c) < aic(at) - 1e-9), None)
        if better is None:
            return sorted((((p, d, q), (sp, sd, sq), v) for (p, q, sp, sq), v in seen.items()), key=lambda r: (r[2], r[0], r[1]))
        at = better
