"""ARIMA terms and the Dickey-Fuller test against plain least squares."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from quarry.operators import timeseries as Ts


def ols(X, y):
    b, *_ = np.linalg.lstsq(X, y, rcond=None)
    return b, float(((y - X @ b) ** 2).sum())


def hannan_rissanen(x, p, d, q, m, upto=None):
    """(coefficients, w, e, first row): rows t of w (differences) with residuals e."""
    w = np.diff(x, d) if d else np.asarray(x, dtype=float)
    end = len(w) if upto is None else upto - d
    e = np.full(len(w), np.nan)
    if q:
        X = np.array([[1.0, *w[t - m:t][::-1]] for t in range(m, len(w))])
        b, _ = ols(X[:end - m], w[m:end])
        e[m:] = w[m:] - X @ b
    first = max(p, m + q if q else 0)
    design = lambda t: [1.0, *[w[t - k] for k in range(1, p + 1)], *[e[t - k] for k in range(1, q + 1)]]
    return design, w, e, first, end


def reference_forecast(x, p, d, q, m, horizon):
    design, w, e, first, end = hannan_rissanen(x, p, d, q, m)
    beta, ssr = ols(np.array([design(t) for t in range(first, end)]), w[first:])
    w, e, levels = list(w), list(e), list(x)
    for _ in range(horizon):
        nxt = beta[0] + sum(beta[k] * w[-k] for k in range(1, p + 1)) + sum(beta[p + k] * e[-k] for k in range(1, q + 1))
        w.append(nxt)
        e.append(0.0)
        levels.append(nxt + {0: 0.0, 1: levels[-1], 2: 2 * levels[-1] - levels[-2]}[d])
    return beta, levels[len(x):]


def series(seed, n):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 1)
    w = np.zeros(n)
    for t in range(1, n):
        w[t] = 0.3 + 0.5 * w[t - 1] + e[t] + 0.4 * e[t - 1]
    return 100 + np.cumsum(w)


def frame(spark, parts):
    rows = [(k, dt.datetime(2020, 1, 1) + dt.timedelta(days=t), None if v is None else float(v)) for k, xs in parts.items() for t, v in enumerate(xs)]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, y double")


@pytest.mark.parametrize("order", [(1, 1, 1), (2, 0, 2), (0, 2, 1), (2, 1, 0)])
@pytest.mark.parametrize("strategy", ["window", "join"])
def test_arima_matches_least_squares(spark, order, strategy):
    p, d, q = order
    parts = {"a": series(1, 150), None: series(2, 90)}
    got = Ts.arima_forecast(frame(spark, parts), "k", "t", "y", order=order, horizon=5, long_ar=3, strategy=strategy).toPandas()
    for k, x in parts.items():
        mine = got[got["k"].isna() if k is None else got["k"] == k].sort_values("step")
        beta, want = reference_forecast(x, p, d, q, 3, 5)
        assert np.allclose(mine["forecast"], want, rtol=1e-7) and np.allclose(mine["coef"].iloc[0], beta, rtol=1e-5, atol=1e-7)
        width = (mine["upper"] - mine["lower"]).to_numpy()
        assert (np.diff(width) >= -1e-9).all() and mine["t"].iloc[0] == pd.Timestamp("2020-01-01") + pd.Timedelta(days=len(x))


def test_arima_without_ma_is_the_autoregression(spark):
    df = frame(spark, {"a": series(5, 80)}).drop("k")
    a = Ts.arima_forecast(df, None, "t", "y", order=(2, 0, 0), horizon=4).toPandas()
    b = Ts.ar_forecast(df, None, "t", "y", p=2, horizon=4).toPandas()
    for c in ("forecast", "lower", "upper"):
        assert np.allclose(a[c], b[c])


def test_arima_short_and_sparse_series(spark):
    gap = list(series(3, 60))
    gap[20] = None
    late = list(series(4, 60))
    late[-1] = None
    got = Ts.arima_forecast(frame(spark, {"short": [1.0, 2.0, 4.0], "late": late, "gap": gap}), "k", "t", "y", horizon=2).toPandas()
    assert got[got.k == "short"]["step"].isna().all() and "needed" in got[got.k == "short"]["reason"].iloc[0]
    assert "missing" in got[got.k == "late"]["reason"].iloc[0] and len(got[got.k == "gap"]) == 2
    assert Ts.arima_forecast(frame(spark, {"x": []}), "k", "t", "y").collect() == []


def test_order_search_matches_brute_force(spark):
    x = series(7, 160)
    got = Ts.arima_select(frame(spark, {"a": x}), "k", "t", "y", max_p=2, max_d=1, max_q=1, long_ar=3).collect()[0]
    cut, best = math.ceil(160 * (1 - 0.2)), None
    for d in (0, 1):
        for p in range(3):
            for q in range(2):
                design, w, e, _, _ = hannan_rissanen(x, 2, d, 1, 3, upto=cut)
                cols = [0, *range(1, p + 1), *range(3, 3 + q)]
                rows = range(1 + 4, 160)  # max_d + reach, as places of the values
                at = lambda t: np.array(design(t - d))[cols]
                beta, _ = ols(np.array([at(t) for t in rows if t < cut]), np.array([w[t - d] for t in rows if t < cut]))
                rmse = math.sqrt(np.mean([(w[t - d] - at(t) @ beta) ** 2 for t in rows if t >= cut]))
                best = min(best or (rmse, d, p, q), (rmse, d, p, q))
    assert (got.d, got.p, got.q) == best[1:] and got.rmse == pytest.approx(best[0], rel=1e-7)


def reference_adf(x, max_lag):
    x = x - x.mean()  # the constant takes it up; a level of 1e6 would cost the plain solution its digits
    n, dx = len(x), np.diff(x)
    L = min(max_lag, n // 2 - 2)
    row = lambda t, p: [1.0, x[t - 1], *[dx[t - 1 - i] for i in range(1, p + 1)]]
    best = None
    for p in range(L + 1):
        ts = range(L + 1, n)
        b, ssr = ols(np.array([row(t, p) for t in ts]), np.array([dx[t - 1] for t in ts]))
        aic = len(ts) * (math.log(2 * math.pi) + math.log(ssr / len(ts)) + 1) + 2 * (2 + p)
        if best is None or aic < best[0] - 1e-9:
            best = (aic, p)
    p = best[1]
    X = np.array([row(t, p) for t in range(p + 1, n)])
    b, ssr = ols(X, dx[p:])
    cov = ssr / (len(X) - 2 - p) * np.linalg.inv(X.T @ X)
    return b[1] / math.sqrt(cov[1, 1]), p, len(X)


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_adf_matches_least_squares(spark, strategy):
    rng = np.random.default_rng(8)
    parts = {"noise": 1e6 + rng.normal(size=120), "walk": np.cumsum(rng.normal(size=200)), None: series(9, 40), "tiny": [1.0, 2.0, 1.5]}
    given = list(parts["walk"])
    given[50:50] = [None]  # left out
    got = {r.k: r for r in Ts.adf(frame(spark, {**parts, "walk": given}), "k", "t", "y", max_lag=6, strategy=strategy).collect()}
    for k in ("noise", "walk", None):
        tau, p, nobs = reference_adf(np.asarray(parts[k], dtype=float), 6)
        assert (got[k].used_lag, got[k].nobs) == (p, nobs) and got[k].adf_stat == pytest.approx(tau, rel=1e-6)
    assert got["tiny"].used_lag == -1 or got["tiny"].nobs <= 2


def test_adf_plans_few_expressions(spark, monkeypatch):
    from quarry.operators import ranking as R

    monkeypatch.setattr(R, "largest_group", lambda df, keys: 1_000_000)
    lags = math.ceil(12 * 10_000**0.25)
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    try:
        plan = Ts.adf(frame(spark, {"a": series(11, 300)}), "k", "t", "y", strategy="window")._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    sums = next(line for line in plan.splitlines() if "Aggregate" in line and "__own" in line)
    assert sums.count("sum(") == 2 * (lags + 1) + 2 < 500


def test_adf_500_rows_is_quick(spark):
    import time

    df = frame(spark, {"a": series(12, 500)})
    Ts.adf(df, "k", "t", "y", max_lag=1).collect()
    start = time.time()
    Ts.adf(df, "k", "t", "y").collect()
    assert time.time() - start < 20
