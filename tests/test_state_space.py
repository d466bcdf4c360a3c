import numpy as np
import pytest

from brindle.operators import ts_forecast as fc
from brindle.operators.state_space import choose_differences, fit_sarima, kalman, polynomials, stationarity, stepwise


def simulate(n, ar=(), ma=(), seed=0, burn=200):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n + burn), np.zeros(n + burn)
    for t in range(max(len(ar), len(ma)), n + burn):
        y[t] = e[t] + sum(a * y[t - k - 1] for k, a in enumerate(ar)) + sum(a * e[t - k - 1] for k, a in enumerate(ma))
    return y[burn:]


@pytest.mark.parametrize("order,seasonal,m", [((1, 0, 1), (1, 0, 1), 4), ((2, 0, 0), (0, 0, 1), 3), ((0, 0, 2), (0, 0, 0), 7), ((0, 0, 0), (0, 0, 0), 7), ((3, 0, 1), (0, 0, 2), 2)])
def test_likelihood_is_that_of_the_joint_distribution(order, seasonal, m):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3, order[0] + order[2] + seasonal[0] + seasonal[2])) * 0.5
    ar, ma = polynomials(x, order, seasonal, m)
    z, n = rng.normal(size=50), 50
    value, variance, _ = kalman(z, ar, ma)
    for row in range(3):
        psi = np.zeros(6000)
        for i in range(len(psi)):
            psi[i] = (1 if i == 0 else ma[row, i - 1] if i <= ma.shape[1] else 0) + sum(ar[row, j - 1] * psi[i - j] for j in range(1, min(i, ar.shape[1]) + 1))
        cov = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(n)])[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
        v = z @ np.linalg.solve(cov, z) / n
        want = -0.5 * (n * (np.log(2 * np.pi * v) + 1) + np.linalg.slogdet(cov)[1])
        assert value[row] == pytest.approx(want, rel=1e-7) and variance[row] == pytest.approx(v, rel=1e-7)


def test_coefficients_are_recovered():
    out = fit_sarima(simulate(1500, ar=(0.6,), ma=(0.4,)), (1, 0, 1), (0, 0, 0), 7)
    assert out["ar"] == pytest.approx([0.6], abs=0.08) and out["ma"] == pytest.approx([0.4], abs=0.08) and out["sigma2"] == pytest.approx(1, abs=0.1)
    seasonal = simulate(1500, ma=(0.5, 0, 0, -0.6, -0.3))  # (1 + 0.5 L)(1 - 0.6 L^4)
    out = fit_sarima(seasonal, (0, 0, 1), (0, 0, 1), 4)
    assert out["ma"][0] == pytest.approx(0.5, abs=0.08) and out["ma"][3] == pytest.approx(-0.6, abs=0.08)


def test_orders_and_differences_are_found():
    y = simulate(600, ar=(0.5, 0.35), seed=3)
    best = stepwise(y, 7, (3, 3, 1, 1))[0]
    assert best[0][1] == 0 and best[0][0] + best[0][2] >= 2 and best[2] < fit_sarima(y, (1, 0, 0), (0, 0, 0), 7)["aic"]
    walk = np.cumsum(simulate(400, seed=4))
    season = np.tile([0, 5, 9, 4, -3, -8, -7], 60) + simulate(420, seed=5) * 0.5
    assert choose_differences(walk, 1) == (1, 0) and choose_differences(season, 7)[1] == 1 and choose_differences(simulate(400, seed=6), 7) == (0, 0)
    assert stationarity(walk) > 0.463 > stationarity(np.diff(walk)) and stationarity(np.zeros(20)) == 0


def test_forecast_of_an_autoregression_and_short_series():
    y = simulate(800, ar=(0.7,), seed=7) + 10
    out = fit_sarima(y, (1, 0, 0), (0, 0, 0), 7, 4)
    a, mean = out["ar"][0], y.mean()
    assert out["yhat"] == pytest.approx([mean + a ** (i + 1) * (y[-1] - mean) for i in range(4)], rel=1e-6)
    assert out["spread"] == pytest.approx(1.96 * np.sqrt(out["sigma2"] * np.cumsum(a ** (2 * np.arange(4)))))
    assert np.isnan(fit_sarima(y[:5], (1, 0, 1), (0, 1, 1), 7, 3)["yhat"]).all()


def test_search_runs_where_a_series_lies(spark):
    y = simulate(150, ar=(0.8,), seed=8)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)] + [("b", i, float(i % 7)) for i in range(12)], "s string, t int, y double")
    rows = fc.arima_order_search(df, "s", "t", "y", most=(1, 1, 0, 0)).collect()
    assert {r["s"] for r in rows if r["chosen"]} == {"a", "b"} and sum(r["chosen"] for r in rows) == 2
    best = next(r for r in rows if r["s"] == "a" and r["chosen"])
    assert best["order"].startswith("((1, 0,") and best["aic"] == min(r["aic"] for r in rows if r["s"] == "a")
