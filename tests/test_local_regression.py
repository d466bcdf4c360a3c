import numpy as np
import pytest

from brindle.operators.local_regression import decompose, decompose_local, local_line


def line_plain(y, span, weight, at):
    """One place: its nearest points, weights by distance, a weighted line by least squares."""
    n = len(y)
    width = min(span, n)
    first = min(max(at - (width - 1) // 2, 0), n - width)
    idx = list(range(first, first + width))
    reach = max(abs(i - at) for i in idx) + max(span - n, 0) // 2
    w = []
    for i in idx:
        d = abs(i - at)
        w.append((1.0 if d <= 0.001 * reach else (1 - (d / reach) ** 3) ** 3 if d < 0.999 * reach else 0.0) * weight[i])
    w = np.array(w)
    if w.sum() <= 0:
        return y[min(max(at, 0), n - 1)]
    x, v = np.array(idx, float), np.array([y[i] for i in idx])
    mean = (w * x).sum() / w.sum()
    if np.sqrt((w * (x - mean) ** 2).sum() / w.sum()) <= 0.001 * (n - 1):
        return (w * v).sum() / w.sum()
    a = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]])
    c = np.linalg.solve(a, [(w * v).sum(), (w * x * v).sum()])
    return c[0] + c[1] * at


@pytest.mark.parametrize("n,span", [(30, 7), (30, 8), (9, 15), (40, 39), (4, 3), (2, 5)])
def test_local_lines_equal_least_squares(n, span):
    rng = np.random.default_rng(n)
    y, weight = rng.normal(size=n) * 10, rng.random(n)
    weight[: n // 4] = 0
    got = local_line(y, span, weight, ends=1)
    want = [line_plain(y, span, weight, at) for at in range(-1, n + 1)]
    assert got == pytest.approx(want, rel=1e-8, abs=1e-8)


def decompose_plain(y, period, span, inner, outer):
    n, low = len(y), period if period % 2 else period + 1
    wide = int(np.ceil(1.5 * period / (1 - 1.5 / span))) | 1
    trend, season, weight = np.zeros(n), np.zeros(n), np.ones(n)
    for turn in range(outer + 1):
        for _ in range(inner):
            rest, long = y - trend, np.zeros(n + 2 * period)
            for phase in range(period):
                part, w = rest[phase::period], weight[phase::period]
                long[phase::period] = [line_plain(part, span, w, at) for at in range(-1, len(part) + 1)]
            slow = long
            for k in (period, period, 3):
                slow = np.array([slow[i : i + k].mean() for i in range(len(slow) - k + 1)])
            season = long[period : period + n] - [line_plain(slow, low, np.ones(n), at) for at in range(n)]
            trend = np.array([line_plain(y - season, wide, weight, at) for at in range(n)])
        if turn < outer:
            off = np.abs(y - trend - season)
            h = 6 * np.median(off)
            weight = np.array([1.0 if o <= 0.001 * h else (1 - (o / h) ** 2) ** 2 if o <= 0.999 * h else 0.0 for o in off])
    return trend, season


def series(n=60, seed=0):
    rng = np.random.default_rng(seed)
    y = 0.3 * np.arange(n) + np.tile([0, 4, 8, 3, -2, -6, -7], n // 7 + 1)[:n] + rng.normal(scale=0.3, size=n)
    y[[11, 30]] += 60
    return y


def test_decomposition_equals_brute_force():
    trend, season, _ = decompose(series(), 7, inner=2, outer=3)
    want = decompose_plain(series(), 7, 7, 2, 3)
    assert trend == pytest.approx(want[0], rel=1e-8, abs=1e-8) and season == pytest.approx(want[1], rel=1e-8, abs=1e-8)


def test_outliers_lose_their_weight(spark):
    y = series(140)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)] + [("b", i, 2.0) for i in range(5)] + [("b", 9, None)], "s string, t int, y double")
    rows = decompose_local(df, "s", "t", "y").collect()
    a = {r["t"]: r for r in rows if r["s"] == "a"}
    assert len(rows) == 145 and a[11]["weight"] == a[30]["weight"] == 0 and a[11]["resid"] > 50
    assert all(abs(a[t]["trend"] - 0.3 * t) < 1.5 for t in a)
    assert all(r["season"] == 0 and r["trend"] == pytest.approx(2) for r in rows if r["s"] == "b")
