"""Time series, many series in parallel (2.15).

A series is the rows of one ``key`` ordered by ``ts``. A series holding a third of
all rows must not sit in one task: rows are sorted into ranges of (key, ts),
lags and centred means are windows inside a range that has copies of the
rows around it, and every estimator is reduced to sums (means, lagged
products, Gram matrices) that Spark aggregates with map-side combine. Only
those small summaries (one row per key) reach grouped pandas, for the small
solves and the short recursive forecasts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import join_on_keys
from quarry.operators.ranking import row_numbers

_UNITS = {"day": ("day", "1 day"), "month": ("month", "1 month"), "hour": ("hour", "1 hour"),
          "week": ("week", "1 week"), "year": ("year", "1 year")}


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key or [])


def resample(df: DataFrame, ts: str, unit: str, aggs: dict, key=None, month_end: bool = True) -> DataFrame:
    """Regular periods with gaps filled (op 15.1, T15): aggregate per
    (key, period), then left-join a per-key spine of every period between
    the key's first and last; sums/counts of empty periods are 0, other
    aggregates NULL. Monthly labels are month ends when ``month_end``.

    ``aggs``: name -> (fn, col) with fn in sum/count/mean/min/max.
    """
    keys = _keys(key)
    trunc, step = _UNITS[unit]
    period = F.date_trunc(trunc, F.col(ts)).cast("timestamp_ntz")
    fns = {"sum": F.sum, "count": F.count, "mean": F.avg, "min": F.min, "max": F.max}
    agg = df.groupBy(*keys, period.alias("__p")).agg(*[fns[f](F.col(c)).alias(n) for n, (f, c) in aggs.items()])
    bounds = agg.groupBy(*keys).agg(F.min("__p").alias("__a"), F.max("__p").alias("__b"))
    spine = bounds.select(*keys, F.explode(F.sequence("__a", "__b", F.expr(f"interval {step}"))).alias("__p"))
    out = join_on_keys(spine, agg, [*keys, "__p"], "left")
    fill = {n: 0 for n, (f, _) in aggs.items() if f in ("sum", "count")}
    out = out.na.fill(fill) if fill else out
    label = F.last_day("__p").cast("timestamp_ntz") if (unit == "month" and month_end) else F.col("__p")
    return out.select(*keys, label.alias(ts), *aggs.keys())


def _positions(df: DataFrame, key, ts: str, y: str) -> DataFrame:
    keys = _keys(key)
    return row_numbers(df.select(*keys, ts, y), keys + [ts], "__g", total=False)


def series_frame(df: DataFrame, key, ts: str, y: str, lags: list[int] | None = None,
                 strategy: str = "auto", with_mean: bool = False) -> DataFrame:
    """``(key..., ts, __x, __pos, __n, __x_lag_k...)``: the value as double,
    its 0-based position in the series, the series length and lagged
    values; ``__m`` is the mean. Lags are windows over ranges of rows with
    the rows before them (:func:`quarry.operators.ranking.halo_frame`);
    positions are row numbers less the first of the key."""
    from quarry.operators.ranking import halo_frame, series_ranges

    keys = _keys(key)
    lags = list(lags or [])
    base = df.select(*keys, ts, F.col(y).cast("double").alias("__x"))
    ranges = series_ranges(base, strategy)
    f, w = halo_frame(base, keys, [ts], max(lags, default=0), 0, ranges, total=False)
    f = f.withColumns({f"__x_lag_{k}": F.lag("__x", k).over(w) for k in lags}) if lags else f
    if ranges <= 1:
        whole = Window.partitionBy(*keys)
        extra = {"__m": F.avg("__x").over(whole)} if with_mean else {}
        return f.withColumns({"__pos": (F.row_number().over(w) - 1).cast("long"), "__n": F.count(F.lit(1)).over(whole), **extra}).drop("__own")
    f = f.filter("__own").drop("__own", "__range")
    st = f.groupBy(*keys).agg(F.min("__g").alias("__g0"), F.count(F.lit(1)).alias("__n"),
                              *([F.avg("__x").alias("__m")] if with_mean else []))
    return join_on_keys(f, st, keys).withColumn("__pos", F.col("__g") - F.col("__g0")).drop("__g", "__g0")


def acf(df: DataFrame, key, ts: str, y: str, nlags: int = 10, strategy: str = "auto") -> DataFrame:
    """Sample autocorrelation (op 15.3), statsmodels' estimator:
    r_k = sum_t (x_t - m)(x_{t-k} - m) / sum_t (x_t - m)^2 per key.
    Lagged values come from :func:`series_frame`; the cross-products are
    summed by a partially aggregated ``groupBy(key)``.
    Returns ``(key..., lag, acf)`` for lag 0..nlags."""
    keys = _keys(key)
    c = series_frame(df, keys, ts, y, list(range(1, nlags + 1)), strategy, with_mean=True)
    xc = F.col("__x") - F.col("__m")
    sums = [F.sum(xc * xc).alias("__c0")]
    sums += [F.sum(xc * (F.col(f"__x_lag_{k}") - F.col("__m"))).alias(f"__c{k}") for k in range(1, nlags + 1)]
    cov = c.groupBy(*keys).agg(*sums)
    structs = [F.struct(F.lit(k).alias("lag"), (F.coalesce(F.col(f"__c{k}"), F.lit(0.0)) / F.col("__c0")).alias("acf"))
               for k in range(0, nlags + 1)]
    return cov.select(*keys, F.explode(F.array(*structs)).alias("__s")).select(*keys, "__s.*")


def _lag_spine(g: DataFrame, keys: list[str], nlags: int) -> DataFrame:
    return g.select(*keys).distinct().withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(nlags))))


def pacf(df: DataFrame, key, ts: str, y: str, nlags: int = 10) -> DataFrame:
    """Partial autocorrelation by Durbin-Levinson on the sample ACF (the
    Yule-Walker 'mle' estimator) (op 15.4). Spark computes the ACF; each
    key's ``nlags + 1`` ACF values go to a grouped pandas step."""
    keys = _keys(key)
    a = acf(df, keys, ts, y, nlags)
    schema = ", ".join([f"{k} {t}" for k, t in a.dtypes if k in keys] + ["lag int", "pacf double"])

    def dl(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["acf"].to_numpy()
        n = len(r) - 1
        out = [1.0]
        phi_prev = np.zeros(0)
        for k in range(1, n + 1):
            if k == 1:
                phi_kk = r[1]
                phi = np.array([phi_kk])
            else:
                num = r[k] - np.dot(phi_prev, r[1:k][::-1])
                den = 1.0 - np.dot(phi_prev, r[1:k])
                phi_kk = num / den if den != 0 else np.nan
                phi = np.append(phi_prev - phi_kk * phi_prev[::-1], phi_kk)
            out.append(float(phi_kk))
            phi_prev = phi
        res = pd.DataFrame({"lag": np.arange(n + 1, dtype="int32"), "pacf": out})
        for k in keys:
            res[k] = pdf[k].iloc[0]
        return res[[*keys, "lag", "pacf"]]

    return a.groupBy(*keys).applyInPandas(dl, schema)


def decompose(df: DataFrame, key, ts: str, y: str, period: int, strategy: str = "auto") -> DataFrame:
    """Additive classical decomposition (op 15.5): trend = centred moving
    average (2 x period when even); seasonal = mean of the detrended
    values at each phase (position mod period), centred to mean 0;
    resid = y - trend - seasonal. Returns (key..., ts, y, trend, seasonal, resid)."""
    from quarry.operators.ranking import moving_average

    keys = _keys(key)
    f = series_frame(df, keys, ts, y, None, strategy).withColumn("phase", F.pmod(F.col("__pos"), F.lit(period)))
    t = moving_average(f, keys, "__pos", "__x", period, "trend", strategy)
    det = t.withColumn("__d", F.col("__x") - F.col("trend"))
    ph = det.groupBy(*keys, "phase").agg(F.avg("__d").alias("__pa"))
    centre = ph.groupBy(*keys).agg(F.avg("__pa").alias("__pm"))
    seas = join_on_keys(ph, centre, keys).select(*keys, "phase", (F.col("__pa") - F.col("__pm")).alias("seasonal"))
    out = join_on_keys(det, seas, [*keys, "phase"], "left")
    return out.select(*keys, ts, F.col("__x").alias(y), "trend", "seasonal",
                      (F.col("__x") - F.col("trend") - F.col("seasonal")).alias("resid"))


# ----------------------------------------------------------- least squares
def _gram(d: DataFrame, keys: list[str], cols: list[str], extra_keys: list[str] | None = None) -> DataFrame:
    """Per key: n, the series length and every sum of products of ``cols`` (upper
    triangle), i.e. the Gram matrix of the design, as aggregates. Rows with a
    NULL in the design take no part. Expressions are
    passed as SQL text: one parse each instead of a chain of Column calls."""
    ek = list(extra_keys or [])
    aggs = ["count(1) AS __n", "max(__n) AS __len"]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(f"sum(`{a}` * `{cols[j]}`) AS __s_{i}_{j}")
    return d.na.drop(subset=cols).groupBy(*keys, *ek).agg(*[F.expr(e) for e in aggs])


def _unpack(row, m: int) -> np.ndarray:
    G = np.zeros((m, m))
    for i in range(m):
        for j in range(i, m):
            G[i, j] = G[j, i] = row[f"__s_{i}_{j}"]
    return G


def _ols_from_gram(G: np.ndarray, n: int, idx: list[int], yi: int):
    """OLS of column ``yi`` on columns ``idx`` from the Gram matrix."""
    A = G[np.ix_(idx, idx)]
    b = G[idx, yi]
    d = np.sqrt(np.clip(np.diag(A), 1e-300, None))  # columns of very different size: solve the scaled system
    beta = np.linalg.lstsq(A / np.outer(d, d), b / d, rcond=None)[0] / d
    ssr = float(G[yi, yi] - 2 * beta @ b + beta @ A @ beta)
    ssr = max(ssr, 0.0)
    return beta, ssr, A


# MacKinnon (1994, 2010) response-surface values for the ADF test with a
# constant and one variable (fixed published values).
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALLP = [2.1659, 1.4412, 0.038269]
ADF_LARGEP = [1.7339, 0.93202, -0.12745, -0.010368]
ADF_CRIT = {"1%": [-3.43035, -6.5393, -16.786, -79.433],
            "5%": [-2.86154, -2.8903, -4.234, -40.040],
            "10%": [-2.56677, -1.5384, -2.809, 0.0]}


def adf_pvalue(tau: float) -> float:
    """MacKinnon approximate p-value for the ADF statistic (constant term)."""
    from math import erf, sqrt

    def ncdf(x):
        return 0.5 * (1 + erf(x / sqrt(2)))
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    c = ADF_SMALLP if tau <= ADF_TAU_STAR else ADF_LARGEP
    return ncdf(sum(ci * tau ** i for i, ci in enumerate(c)))


def _adf_gram(n: int, start: int, lags: int, head: np.ndarray, tail: np.ndarray, own: np.ndarray, cross: np.ndarray,
              level: float, level_sq: float) -> np.ndarray:
    """Gram matrix of (1, x[t-1], dx[t-1] .. dx[t-lags], dx[t]) over t = start .. n-1.

    ``own[k]`` sums dx[t] dx[t-k], ``cross[k]`` sums x[t-1] dx[t-k], ``level`` and
    ``level_sq`` x[t-1] and its square, each over every t where it is defined; what
    lies before ``start`` and, shifted, at the end comes from the first and
    last values ``head`` and ``tail``.
    """
    dh, dt = np.diff(head), np.diff(tail)  # dh[u - 1] = dx[u]; dt[-1] = dx[n - 1]

    def early(k: int, upto: int) -> float:  # dx[u] dx[u-k] for u = k+1 .. upto
        return float(dh[k:upto] @ dh[:upto - k]) if upto > k else 0.0

    def late(k: int, last: int) -> float:  # dx[u] dx[u-k] for the last ``last`` u
        return float(dt[len(dt) - last:] @ dt[len(dt) - last - k:len(dt) - k]) if last else 0.0

    order = [*range(1, lags + 1), 0]  # the columns after (1, x[t-1])
    m = lags + 3
    G = np.zeros((m, m))
    G[0, 0] = n - start
    G[0, 1] = level - head[:start - 1].sum()
    G[1, 1] = level_sq - (head[:start - 1] ** 2).sum()
    for a, i in enumerate(order):
        G[0, 2 + a] = tail[len(tail) - 1 - i] - head[start - 1 - i]
        G[1, 2 + a] = cross[i] - float(head[i:start - 1] @ dh[:start - 1 - i])
        for c in range(a, len(order)):
            j = order[c]
            lo, k = min(i, j), abs(i - j)
            G[2 + a, 2 + c] = own[k] - early(k, start - lo - 1) - late(k, lo)
    return np.triu(G) + np.triu(G, 1).T


def adf(df: DataFrame, key, ts: str, y: str, max_lag: int | None = None, strategy: str = "auto") -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag order chosen by
    AIC (op 15.6, re-aimed). Regression dy_t = a + b y_{t-1} +
    sum_{i<=p} c_i dy_{t-i} + e over a sample common to every candidate p;
    the chosen p is refitted on its largest sample. The largest p of a key is
    min(``max_lag`` or ceil(12 (n / 100)^(1/4)), n // 2 - 2) for its own length n.
    Rows with a NULL value are left out before the test.

    Every entry of every Gram matrix is a lagged sum over the whole series less
    a few products at its ends. So Spark adds up 2 (L + 1) lagged products per key
    and hands over the first and last L + 2 values; grouped pandas solves
    the small systems.
    Returns (key..., adf_stat, p_value, used_lag, nobs, crit_1, crit_5, crit_10).
    """
    keys = _keys(key)
    df = df.filter(F.col(y).isNotNull())
    given = max_lag is not None
    if not given:
        from quarry.operators.ranking import largest_group

        longest = largest_group(df, keys)
        max_lag = int(math.ceil(12.0 * (longest / 100.0) ** 0.25))
    L = max_lag
    f = series_frame(df, keys, ts, y, list(range(1, L + 2)), strategy, with_mean=True)
    # centred: the constant takes up the mean, and sums stay small
    f = f.select(*keys, "__pos", "__n", (F.col("__x") - F.col("__m")).alias("x0"),
                 *[(F.col(f"__x_lag_{k}") - F.col("__m")).alias(f"x{k}") for k in range(1, L + 2)])
    step = [f"(x{k} - x{k + 1})" for k in range(L + 1)]
    sums = [f"sum({step[0]} * {step[k]})" for k in range(L + 1)]
    cross = [f"sum(x1 * {step[k]})" for k in range(L + 1)]
    ends = lambda cond, name: F.expr(f"sort_array(collect_list(if({cond}, struct(__pos, x0), null))).x0").alias(name)
    got = f.groupBy(*keys).agg(
        F.max("__n").alias("__n"), F.expr("sum(x1)").alias("__level"), F.expr("sum(x1 * x1)").alias("__sq"),
        F.expr(f"array({', '.join(sums)})").alias("__own"), F.expr(f"array({', '.join(cross)})").alias("__cross"),
        ends(f"__pos < {L + 2}", "__head"), ends(f"__pos >= __n - {L + 2}", "__tail"))
    key_schema = [f"{k} {t}" for k, t in df.dtypes if k in keys]
    out_schema = ", ".join(key_schema + ["adf_stat double", "p_value double", "used_lag int", "nobs long",
                                         "crit_1 double", "crit_5 double", "crit_10 double"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        res = {k: row[k] for k in keys}
        n = int(row["__n"])
        most = min(L if given else math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2, L)
        if most < 0 or n - most - 1 <= most + 2:
            return pd.DataFrame([{**res, "adf_stat": np.nan, "p_value": np.nan, "used_lag": -1, "nobs": 0,
                                  "crit_1": np.nan, "crit_5": np.nan, "crit_10": np.nan}])
        parts = [np.array(row[c], dtype=float) for c in ("__head", "__tail", "__own", "__cross")]

        def fit(start: int, lags: int, p: int):
            G = _adf_gram(n, start, lags, *parts, float(row["__level"]), float(row["__sq"]))
            return _ols_from_gram(G, n - start, list(range(2 + p)), lags + 2), n - start

        best, best_aic = 0, np.inf
        common = _adf_gram(n, most + 1, most, *parts, float(row["__level"]), float(row["__sq"]))
        rows = n - most - 1
        for p in range(most + 1):
            _, ssr, _ = _ols_from_gram(common, rows, list(range(2 + p)), most + 2)
            llf = -rows / 2.0 * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / rows) + 1)
            aic = -2 * llf + 2 * (2 + p)
            if aic < best_aic - 1e-12:
                best, best_aic = p, aic
        (beta, ssr, A), n2 = fit(best + 1, best, best)
        cov = ssr / (n2 - 2 - best) * np.linalg.pinv(A)
        tau = float(beta[1] / math.sqrt(cov[1, 1])) if cov[1, 1] > 0 else np.nan
        crit = {k: v[0] + v[1] / n2 + v[2] / n2 ** 2 + v[3] / n2 ** 3 for k, v in ADF_CRIT.items()}
        return pd.DataFrame([{**res, "adf_stat": tau, "p_value": adf_pvalue(tau) if np.isfinite(tau) else np.nan,
                              "used_lag": best, "nobs": n2, "crit_1": crit["1%"], "crit_5": crit["5%"], "crit_10": crit["10%"]}])

    return got.groupBy(*keys).applyInPandas(solve, out_schema)


def _ar_design(df: DataFrame, keys: list[str], ts: str, y: str, lags: list[int], strategy: str = "auto"):
    d = series_frame(df, keys, ts, y, lags, strategy)
    return d.withColumn("one", F.lit(1.0))


def ar_forecast(df: DataFrame, key, ts: str, y: str, p: int = 1, horizon: int = 12,
                seasonal_lags: list[int] | None = None, step: str = "1 day", z: float = 1.96,
                strategy: str = "auto") -> DataFrame:
    """AR(p) (+ optional seasonal lags) with intercept, least squares, and a
    recursive ``horizon``-step forecast with a +-z sigma sqrt(sum psi^2)
    band (op 15.7; a different estimator than state-space ARIMA: stated).
    Returns (key..., step, ts, forecast, lower, upper, reason). A series too
    short or too sparse for the fit gives one row with step NULL and the reason."""
    keys = _keys(key)
    lags = sorted(set(list(range(1, p + 1)) + list(seasonal_lags or [])))
    L = max(lags)
    d = _ar_design(df, keys, ts, y, lags, strategy)
    cols = ["one", *[f"__x_lag_{k}" for k in lags], "__x"]
    G = _gram(d.filter(F.col("__pos") >= L), keys, cols)
    # last L values and last ts per key: the rows nearest the end (L per key)
    tail = d.filter(F.col("__pos") >= F.col("__n") - L).select(*keys, "__pos", ts, "__x")
    tail_agg = tail.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__pos", "__x"))).alias("__tail"),
                                       F.max(ts).alias("__last"))
    both = join_on_keys(tail_agg, G, keys, "left")
    m = len(cols)
    key_schema = [f"{k} {t}" for k, t in df.dtypes if k in keys]
    out_schema = ", ".join(key_schema + ["step int", "forecast double", "lower double", "upper double", "reason string", "__last timestamp_ntz"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        n = int(row["__n"]) if pd.notna(row["__n"]) else 0
        base = {k: row[k] for k in keys}
        reason = f"{n} complete rows, {m + 1} needed" if n <= m else None
        if reason is None and any(t["__x"] is None for t in row["__tail"]):
            reason = "a missing value among the last lags"
        if reason:
            return pd.DataFrame([{**base, "step": None, "forecast": None, "lower": None, "upper": None, "reason": reason, "__last": row["__last"]}])
        Gm = _unpack(row, m)
        beta, ssr, _ = _ols_from_gram(Gm, n, list(range(m - 1)), m - 1)
        sigma = math.sqrt(ssr / max(n - (m - 1), 1))
        hist = [float(t["__x"]) for t in row["__tail"]]
        phi = np.zeros(L + 1)
        for i, k in enumerate(lags):
            phi[k] = beta[1 + i]
        psi = [1.0]
        out = []
        for h in range(1, horizon + 1):
            f = beta[0] + sum(phi[k] * hist[-k] for k in lags)
            hist.append(f)
            var = sum(v * v for v in psi)
            band = z * sigma * math.sqrt(var)
            out.append({**base, "step": h, "forecast": f, "lower": f - band, "upper": f + band, "reason": None, "__last": row["__last"]})
            psi.append(sum(phi[k] * psi[h - k] for k in range(1, min(h, L) + 1)))
        return pd.DataFrame(out)

    res = both.groupBy(*keys).applyInPandas(run, out_schema)
    return res.select(*keys, "step", (F.col("__last") + F.expr(f"interval {step}") * F.col("step")).alias(ts),
                      "forecast", "lower", "upper", "reason")


def ar_select(df: DataFrame, key, ts: str, y: str, max_p: int = 8, strategy: str = "auto", hold_out: float = 0.2) -> DataFrame:
    """AR order search (op 15.8): one Gram matrix per key and part, on the
    sample where all ``max_p`` lags exist, serves every p. Each p is fitted
    on the first part; the p with the lowest one-step RMSE on the last
    ``hold_out`` share of the series (ties -> smaller p) is kept, with the
    AIC of its fit. Returns (key..., p, rmse, aic)."""
    keys = _keys(key)
    lags = list(range(1, max_p + 1))
    d = _ar_design(df, keys, ts, y, lags, strategy)
    cols = ["one", *[f"__x_lag_{k}" for k in lags], "__x"]
    test = (F.col("__pos") >= F.ceil(F.col("__n") * (1 - hold_out))).cast("int")
    G = _gram(d.filter(F.col("__pos") >= max_p).withColumn("__test", test), keys, cols, ["__test"])
    m = len(cols)
    key_schema = [f"{k} {t}" for k, t in df.dtypes if k in keys]
    schema = ", ".join(key_schema + ["p int", "rmse double", "aic double"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {int(r["__test"]): r for _, r in pdf.iterrows()}
        out = []
        if set(parts) == {0, 1}:
            n, nt = int(parts[0]["__n"]), int(parts[1]["__n"])
            fit, held = _unpack(parts[0], m), _unpack(parts[1], m)
            for p in range(1, max_p + 1):
                if n <= p + 1:
                    continue
                idx = list(range(p + 1))
                beta, ssr, _ = _ols_from_gram(fit, n, idx, m - 1)
                llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / n) + 1)
                miss = held[m - 1, m - 1] - 2 * beta @ held[idx, m - 1] + beta @ held[np.ix_(idx, idx)] @ beta
                out.append({**{k: pdf[k].iloc[0] for k in keys}, "p": p, "rmse": math.sqrt(max(float(miss), 0.0) / nt),
                            "aic": -2 * llf + 2 * (p + 1)})
        return pd.DataFrame(out, columns=[*keys, "p", "rmse", "aic"])

    scores = G.groupBy(*keys).applyInPandas(run, schema)
    return scores.groupBy(*keys).agg(
        F.min_by(F.struct("p", "rmse", "aic"), F.struct("rmse", "p")).alias("b")).select(*keys, "b.*")


# ------------------------------------------------------------------- ARIMA
def _long_ar(p: int, q: int, given: int | None) -> int:
    return given if given is not None else max(p, q) + 4


def _differences(f: DataFrame, keep: list[str], d: int, count: int) -> DataFrame:
    """w0 .. w<count>: the value differenced ``d`` times, now and ``k`` rows before."""
    x = ["__x", *[f"__x_lag_{k}" for k in range(1, count + d + 1)]]
    w = [" + ".join(f"({(-1) ** i * math.comb(d, i)}) * `{x[k + i]}`" for i in range(d + 1)) + f" AS w{k}" for k in range(count + 1)]
    return f.selectExpr(*[f"`{c}`" for c in keep], "1.0D AS one", *w)


def _long_fit(rows: DataFrame, keys: list[str], m: int, types: dict[str, str]) -> DataFrame:
    """(key..., __b): coefficients of the long autoregression of w0 on w1 .. wm, NULL
    where it has too few rows."""
    G = _gram(rows, keys, ["one", *[f"w{k}" for k in range(1, m + 1)], "w0"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["__n"].iloc[0])
        b = [_ols_from_gram(_unpack(pdf.iloc[0], m + 2), n, list(range(m + 1)), m + 1)[0].tolist() if n > m + 1 else None]
        return pd.DataFrame({**{k: pdf[k].iloc[:1].to_list() for k in keys}, "__b": b})

    return G.groupBy(*keys).applyInPandas(run, ", ".join([f"{k} {types[k]}" for k in keys] + ["__b array<double>"]))


def _with_residuals(rows: DataFrame, long: DataFrame, keys: list[str], m: int, q: int) -> DataFrame:
    """``rows`` with e1 .. eq, residuals of the long autoregression one to ``q`` rows before."""
    got = join_on_keys(rows, long, keys, "left")
    e = [f"w{j} - __b[0]" + "".join(f" - __b[{i}] * w{j + i}" for i in range(1, m + 1)) + f" AS e{j}" for j in range(1, q + 1)]
    return got.selectExpr("*", *e) if e else got


def arima_forecast(df: DataFrame, key, ts: str, y: str, order: tuple[int, int, int] = (1, 1, 1), horizon: int = 12,
                   long_ar: int | None = None, step: str = "1 day", z: float = 1.96, strategy: str = "auto") -> DataFrame:
    """ARIMA(p, d, q) with intercept by Hannan-Rissanen, and forecasts with a band (op 15.7).

    The values are differenced ``d`` times; a long autoregression (``long_ar`` lags,
    by default max(p, q) + 4) gives residuals; least squares on ``p`` lagged
    differences and ``q`` lagged residuals gives the coefficients (another
    estimator than exact likelihood: stated). Forecasts run on with
    future residuals zero and are summed back; the band is +- z sigma
    sqrt(sum psi^2). Both regressions are sums of products per key.
    Returns (key..., step, ts, forecast, lower, upper, reason, coef): ``coef`` is
    (intercept, AR, MA). A series too short, or with a missing value near its
    end, gives one row with step NULL and the reason; rows whose lags are
    missing take no part in the fit.
    """
    keys = _keys(key)
    p, d, q = order
    m = _long_ar(p, q, long_ar) if q else 0
    reach = max(p, m + q)
    types = dict(df.dtypes)
    f = series_frame(df, keys, ts, y, list(range(1, reach + d + 1)), strategy)
    rows = _differences(f, [*keys, "__pos", "__n"], d, reach)
    cols = ["one", *[f"w{k}" for k in range(1, p + 1)], *[f"e{k}" for k in range(1, q + 1)], "w0"]
    if q:
        long = _long_fit(rows.filter(F.col("__pos") >= d + m), keys, m, types)
        rows = _with_residuals(rows, long, keys, m, q)
    G = _gram(rows.filter(F.col("__pos") >= d + reach), keys, cols)
    last = max(1, d + reach)
    tail = f.filter(F.col("__pos") >= F.col("__n") - last).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("__pos", "__x"))).alias("__tail"), F.max(ts).alias("__last"))
    both = join_on_keys(tail, G, keys, "left")
    both = join_on_keys(both, long, keys, "left") if q else both.withColumn("__b", F.lit(None).cast("array<double>"))
    size = len(cols)
    schema = ", ".join([f"{k} {types[k]}" for k in keys] + ["step int", "forecast double", "lower double", "upper double", "reason string",
                                                            "coef array<double>", "__last timestamp_ntz"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        base = {**{k: row[k] for k in keys}, "__last": row["__last"]}
        n = int(row["__n"]) if pd.notna(row["__n"]) else 0
        x = [t["__x"] for t in row["__tail"]]
        reason = f"{n} complete rows, {size + 1} needed" if n <= size else None
        if reason is None and (len(x) < d + reach or any(v is None for v in x)):
            reason = "a missing value among the last lags"
        if reason:
            return pd.DataFrame([{**base, "step": None, "forecast": None, "lower": None, "upper": None, "reason": reason, "coef": None}])
        beta, ssr, _ = _ols_from_gram(_unpack(row, size), n, list(range(size - 1)), size - 1)
        sigma = math.sqrt(ssr / max(n - size + 1, 1))
        phi, theta = beta[1:1 + p], beta[1 + p:]
        w = list(np.diff(np.array(x, dtype=float), d)) if d else [float(v) for v in x]
        e = [w[len(w) - j] - row["__b"][0] - sum(row["__b"][i] * w[len(w) - j - i] for i in range(1, m + 1)) for j in range(q, 0, -1)] if q else []
        levels = [float(v) for v in x]
        back = [-((-1) ** i) * math.comb(d, i) for i in range(1, d + 1)]  # x[t] = w[t] + sum back[i] x[t-i]
        ar = -np.convolve(np.concatenate([[1.0], -phi]), np.array([(-1) ** i * math.comb(d, i) for i in range(d + 1)], dtype=float))[1:]
        psi, out = [1.0], []
        for h in range(1, horizon + 1):
            nxt = beta[0] + sum(phi[k] * w[-1 - k] for k in range(p)) + sum(theta[k] * e[-1 - k] for k in range(q))
            w.append(nxt)
            e.append(0.0)
            levels.append(nxt + sum(c * levels[-1 - k] for k, c in enumerate(back)))
            band = z * sigma * math.sqrt(sum(v * v for v in psi))
            out.append({**base, "step": h, "forecast": levels[-1], "lower": levels[-1] - band, "upper": levels[-1] + band, "reason": None, "coef": beta.tolist()})
            psi.append((theta[h - 1] if h <= q else 0.0) + sum(ar[k - 1] * psi[h - k] for k in range(1, min(h, len(ar)) + 1)))
        return pd.DataFrame(out)

    res = both.groupBy(*keys).applyInPandas(run, schema)
    return res.select(*keys, "step", (F.col("__last") + F.expr(f"interval {step}") * F.col("step")).alias(ts),
                      "forecast", "lower", "upper", "reason", "coef")


def arima_select(df: DataFrame, key, ts: str, y: str, max_p: int = 2, max_d: int = 1, max_q: int = 2, hold_out: float = 0.2,
                 long_ar: int | None = None, strategy: str = "auto") -> DataFrame:
    """Order search over (p, d, q) (op 15.8): the order with the lowest one-step RMSE
    on the last ``hold_out`` share of each series (ties -> smaller d, p, q).

    All orders are fitted and scored on the same rows. Per d one long
    autoregression of the first part gives the residuals, and one Gram matrix per part
    serves every (p, q); an error of the difference is the error of the
    value. Returns (key..., p, d, q, rmse, aic)."""
    from functools import reduce

    keys = _keys(key)
    types = dict(df.dtypes)
    m = _long_ar(max_p, max_q, long_ar) if max_q else 0
    reach = max(max_p, m + max_q)
    f = series_frame(df, keys, ts, y, list(range(1, reach + max_d + 1)), strategy)
    cols = ["one", *[f"w{k}" for k in range(1, max_p + 1)], *[f"e{k}" for k in range(1, max_q + 1)], "w0"]
    size = len(cols)
    grams = []
    for d in range(max_d + 1):
        rows = _differences(f, [*keys, "__pos", "__n"], d, reach)
        rows = rows.withColumn("__test", (F.col("__pos") >= F.ceil(F.col("__n") * (1 - hold_out))).cast("int"))
        if max_q:
            long = _long_fit(rows.filter((F.col("__pos") >= d + m) & (F.col("__test") == 0)), keys, m, types)
            rows = _with_residuals(rows, long, keys, m, max_q)
        grams.append(_gram(rows.filter(F.col("__pos") >= max_d + reach), keys, cols, ["__test"]).withColumn("__d", F.lit(d)))
    schema = ", ".join([f"{k} {types[k]}" for k in keys] + ["p int", "d int", "q int", "rmse double", "aic double"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d in range(max_d + 1):
            parts = {int(r["__test"]): r for _, r in pdf[pdf["__d"] == d].iterrows()}
            if set(parts) != {0, 1}:
                continue
            n, nt = int(parts[0]["__n"]), int(parts[1]["__n"])
            fit, held = _unpack(parts[0], size), _unpack(parts[1], size)
            for p in range(max_p + 1):
                for q in range(max_q + 1):
                    idx = [*range(p + 1), *range(1 + max_p, 1 + max_p + q)]
                    if n <= len(idx) + 1:
                        continue
                    beta, ssr, _ = _ols_from_gram(fit, n, idx, size - 1)
                    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / n) + 1)
                    miss = held[size - 1, size - 1] - 2 * beta @ held[idx, size - 1] + beta @ held[np.ix_(idx, idx)] @ beta
                    out.append({**{k: pdf[k].iloc[0] for k in keys}, "p": p, "d": d, "q": q,
                                "rmse": math.sqrt(max(float(miss), 0.0) / nt), "aic": -2 * llf + 2 * len(idx)})
        return pd.DataFrame(out, columns=[*keys, "p", "d", "q", "rmse", "aic"])

    scores = reduce(DataFrame.unionByName, grams).groupBy(*keys).applyInPandas(run, schema)
    return scores.groupBy(*keys).agg(
        F.min_by(F.struct("p", "d", "q", "rmse", "aic"), F.struct("rmse", "d", "p", "q")).alias("b")).select(*keys, "b.*")


def attach_forecast(history: DataFrame, forecast: DataFrame, key, ts: str) -> DataFrame:
    """History with the forecast rows appended / joined by (key, ts) (op 15.10)."""
    keys = _keys(key)
    return history.join(forecast, [*keys, ts], "full")


def demand_forecast(train: DataFrame, test: DataFrame, ts: str, y: str, rounds: int = 50, depth: int = 4,
                    validation_frac: float = 0.15, seed: int = 42):
    """Calendar-feature demand model (op 15.9): calendar features (10.4),
    boosted trees with early stopping on the last ``validation_frac`` of
    the training period, test-set predictions and regression metrics."""
    from quarry.functions.dates import calendar_features
    from quarry.operators.metrics import reg_metrics
    from quarry.operators.models import fit_gbt_reg

    feats = ["hour", "dayofweek", "quarter", "month", "year", "dayofyear", "dayofmonth", "weekofyear"]
    tr = calendar_features(train, ts)
    cut = tr.select(F.percentile_approx(F.unix_micros(F.col(ts).cast("timestamp")), 1 - validation_frac, 10000)).scalar()
    tr = tr.withColumn("__val", F.unix_micros(F.col(ts).cast("timestamp")) > F.lit(cut))
    model = fit_gbt_reg(tr, feats, y, rounds=rounds, depth=depth, validation="__val", seed=seed)
    pred = model.transform(calendar_features(test, ts)).select(ts, y, "prediction")
    return pred, reg_metrics(pred, y, "prediction")
