"""Time-series analyses (2.15): per event type daily / hourly series from
``events`` (trips: vendor -> event_type, passengers -> value), monthly
order series per status."""

from pyspark.sql import functions as F

from quarry.operators import timeseries as Ts
from quarry.plans.registry import T, query


def r6(c):
    return F.round(F.col(c), 6)


def daily_series(spark, sf):
    """Daily value totals per event type, gap-filled."""
    e = T(spark, sf, "events")
    return Ts.resample(e, "ts", "day", {"total": ("sum", "value")}, key="event_type")


_DAILY_SQL = """
select event_type, cast(cast(ts as date) as timestamp) as ts, sum(value) as total from events group by 1, 2
"""


@query("resample_hourly_gaps", """
with a as (
  select event_type, date_trunc('hour', ts) as p, round(sum(value), 2) as total, count(*) as n
  from events group by 1, 2
), b as (select event_type, min(p) as lo, max(p) as hi from a group by 1),
s as (select event_type, unnest(generate_series(lo, hi, interval 1 hour)) as p from b)
select s.event_type, s.p as ts, coalesce(a.total, 0) as total, coalesce(a.n, 0) as n
from s left join a on a.event_type = s.event_type and a.p = s.p
""")
def resample_hourly_gaps(spark, sf):
    """15.1 hourly resample with empty periods emitted as 0 (T15)."""
    e = T(spark, sf, "events")
    r = Ts.resample(e, "ts", "hour", {"total": ("sum", "value"), "n": ("count", "value")}, key="event_type")
    return r.withColumn("total", F.round("total", 2))


@query("resample_daily_by_user", """
with a as (
  select user_id, date_trunc('day', ts) as p, round(sum(value), 2) as total, count(*) as n from events group by 1, 2
), b as (select user_id, min(p) as lo, max(p) as hi from a group by 1),
s as (select user_id, unnest(generate_series(lo, hi, interval 1 day)) as p from b)
select s.user_id, s.p::timestamp as ts, coalesce(a.total, 0) as total, coalesce(a.n, 0) as n
from s left join a on a.user_id = s.user_id and a.p = s.p
""")
def resample_daily_by_user(spark, sf):
    """15.1 daily resample of every user: most days are gaps (T15)."""
    r = Ts.resample(T(spark, sf, "events"), "ts", "day", {"total": ("sum", "value"), "n": ("count", "value")}, key="user_id")
    return r.withColumn("total", F.round("total", 2))


@query("resample_monthly_month_end", """
with a as (
  select o_orderstatus, date_trunc('month', o_orderdate) as p, count(*) as n_orders,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
  from orders group by 1, 2
), b as (select o_orderstatus, min(p) as lo, max(p) as hi from a group by 1),
s as (select o_orderstatus, unnest(generate_series(lo, hi, interval 1 month)) as p from b)
select s.o_orderstatus, cast(last_day(s.p) as timestamp) as o_orderdate, coalesce(a.n_orders, 0) as n_orders,
  coalesce(a.total, 0) as total
from s left join a on a.o_orderstatus = s.o_orderstatus and a.p = s.p
""")
def resample_monthly_month_end(spark, sf):
    """15.1 monthly resample labelled by month end."""
    o = T(spark, sf, "orders").withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)"))
    r = Ts.resample(o, "o_orderdate", "month", {"n_orders": ("count", "o_orderkey"), "total": ("sum", "amt")},
                    key="o_orderstatus")
    return r.withColumn("total", F.col("total").cast("double"))


@query("daily_totals_no_fill", """
select cast(cast(ts as date) as timestamp) as day, round(sum(value), 2) as total from events group by 1
""")
def daily_totals_no_fill(spark, sf):
    """15.2 daily aggregate without gap fill."""
    e = T(spark, sf, "events")
    return e.groupBy(F.to_date("ts").cast("timestamp_ntz").alias("day")).agg(F.round(F.sum("value"), 2).alias("total"))


@query("acf_daily", f"""
with d as ({_DAILY_SQL}),
p as (select event_type, total, row_number() over (partition by event_type order by ts) as rn from d),
m as (select event_type, avg(total) as mu from p group by 1),
c as (select p.event_type, p.rn, p.total - m.mu as x from p join m using (event_type)),
l as (select a.event_type, a.rn - b.rn as lag, sum(a.x * b.x) as s from c a join c b
      on a.event_type = b.event_type and a.rn - b.rn between 0 and 7 group by 1, 2)
select l.event_type, l.lag::integer as lag, round(l.s / z.s, 6) as acf from l join l z on z.event_type = l.event_type and z.lag = 0
""")
def acf_daily(spark, sf):
    """15.3 autocorrelation of each type's daily totals, lags 0..7."""
    a = Ts.acf(daily_series(spark, sf), "event_type", "ts", "total", 7)
    return a.select("event_type", F.col("lag").cast("int").alias("lag"), r6("acf").alias("acf"))


_ACF_SQL = """
p as (select k, ts, total, row_number() over (partition by k order by ts) as rn from d),
m as (select k, avg(total) as mu from p group by 1),
c as (select p.k, p.rn, p.total - m.mu as x from p join m on p.k is not distinct from m.k),
l as (select a.k, a.rn - b.rn as lag, sum(a.x * b.x) as s from c a join c b
      on a.k is not distinct from b.k and a.rn - b.rn between 0 and 7 group by 1, 2),
r as (select l.k, l.lag::integer as lag, l.s / z.s as acf from l join l z on z.k is not distinct from l.k and z.lag = 0)
"""


@query("acf_daily_join", f"""
with d as (select nullif(event_type, 'click') as k, ts, total from ({_DAILY_SQL})), {_ACF_SQL}
select k, lag, round(acf, 6) as acf from r
""")
def acf_daily_join(spark, sf):
    """15.3 by position joins, as for series too long for a key window, with a
    NULL key."""
    d = daily_series(spark, sf).withColumn("k", F.nullif("event_type", F.lit("click")))
    a = Ts.acf(d, "k", "ts", "total", 7, strategy="join")
    return a.select("k", F.col("lag").cast("int").alias("lag"), r6("acf").alias("acf"))


@query("pacf_daily_two", f"""
with d as (select event_type as k, ts, total from ({_DAILY_SQL})), {_ACF_SQL}
select a.k as event_type, round(a.acf, 6) as pacf1, round((b.acf - a.acf * a.acf) / (1 - a.acf * a.acf), 6) as pacf2
from r a join r b on a.k = b.k and a.lag = 1 and b.lag = 2
""")
def pacf_daily_two(spark, sf):
    """15.4 the first two partial autocorrelations, which have a closed form."""
    p = Ts.pacf(daily_series(spark, sf), "event_type", "ts", "total", 2)
    at = lambda k: F.round(F.max(F.when(F.col("lag") == k, F.col("pacf"))), 6).alias(f"pacf{k}")
    return p.groupBy("event_type").agg(at(1), at(2))


@query("pacf_daily", None)
def pacf_daily(spark, sf):
    """15.4 partial autocorrelation (Durbin-Levinson on the ACF)."""
    return Ts.pacf(daily_series(spark, sf), "event_type", "ts", "total", 7)


@query("decompose_weekly", f"""
with d as ({_DAILY_SQL}),
p as (select *, row_number() over (partition by event_type order by ts) - 1 as pos from d),
t as (select *, case when count(total) over w = 7 then avg(total) over w end as trend, pos % 7 as phase from p
      window w as (partition by event_type order by pos rows between 3 preceding and 3 following)),
ph as (select event_type, phase, avg(total - trend) as pa from t group by 1, 2),
c as (select event_type, avg(pa) as pm from ph group by 1),
s as (select ph.event_type, ph.phase, ph.pa - c.pm as seasonal from ph join c using (event_type))
select t.event_type, t.ts, round(t.total, 6) as total, round(t.trend, 6) as trend, round(s.seasonal, 6) as seasonal,
  round(t.total - t.trend - s.seasonal, 6) as resid
from t join s on s.event_type = t.event_type and s.phase = t.phase
""")
def decompose_weekly(spark, sf):
    """15.5 additive decomposition with a weekly period (trend NULL at the edges)."""
    d = Ts.decompose(daily_series(spark, sf), "event_type", "ts", "total", 7)
    return d.select("event_type", "ts", *[r6(c).alias(c) for c in ("total", "trend", "seasonal", "resid")])


@query("adf_daily", None)
def adf_daily(spark, sf):
    """15.6 ADF stationarity test per type (AIC lag choice, MacKinnon p-value)."""
    return Ts.adf(daily_series(spark, sf), "event_type", "ts", "total")


@query("adf_hourly", None)
def adf_hourly(spark, sf):
    """15.6 ADF on the hourly value series of every type."""
    e = T(spark, sf, "events")
    h = Ts.resample(e, "ts", "hour", {"v": ("sum", "value")}, key="event_type")
    return Ts.adf(h, "event_type", "ts", "v")


@query("adf_zero_lag_daily", f"""
with d as ({_DAILY_SQL}),
l as (select event_type, total - lag(total) over w as dy, lag(total) over w as y1 from d window w as (partition by event_type order by ts)),
r as (select event_type, regr_count(dy, y1) as n, regr_slope(dy, y1) as b, regr_sxx(dy, y1) as sxx, regr_syy(dy, y1) as syy, regr_sxy(dy, y1) as sxy
      from l group by 1)
select event_type, round(b / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx), 6) as adf_stat, 0 as used_lag, n::bigint as nobs from r
""")
def adf_zero_lag_daily(spark, sf):
    """15.6 Dickey-Fuller test without lagged differences: a simple regression."""
    a = Ts.adf(daily_series(spark, sf), "event_type", "ts", "total", max_lag=0)
    return a.select("event_type", r6("adf_stat").alias("adf_stat"), "used_lag", "nobs")


@query("ar_forecast_daily", None)
def ar_forecast_daily(spark, sf):
    """15.7 AR(2) + weekly lag forecast, 7 days ahead with a 95 % band."""
    return Ts.ar_forecast(daily_series(spark, sf), "event_type", "ts", "total", p=2, horizon=7,
                          seasonal_lags=[7], step="1 day")


def _ar1(d: str, steps: int, upto: str = "true") -> str:
    """SQL: AR(1) by least squares on the rows of ``d`` (k, pos, y) that fulfil
    ``upto``, and its recursive forecasts ``f`` (k, step, y)."""
    return f"""
t as (select * from {d} where {upto}),
g as (select a.k, regr_slope(a.y, b.y) as b, regr_intercept(a.y, b.y) as a
      from t a join t b on a.k is not distinct from b.k and b.pos = a.pos - 1 group by 1),
z as (select k, max(pos) as n, max_by(y, pos) as y from t group by 1),
f as (select z.k, z.n, s.step, g.a * (1 - power(g.b, s.step)) / (1 - g.b) + power(g.b, s.step) * z.y as y
      from z join g on z.k is not distinct from g.k, (select unnest(range(1, {steps + 1})) as step) s)
"""


_MONTHS = """
mo as (select date_trunc('month', o_orderdate)::timestamp as ts, sum(o_totalprice) as y from orders group by 1),
d as (select 0 as k, ts, y, row_number() over (order by ts) - 1 as pos from mo)
"""


def _months(spark, sf):
    """Monthly order totals: one series without a key."""
    return Ts.resample(T(spark, sf, "orders"), "o_orderdate", "month", {"y": ("sum", "o_totalprice")}, month_end=False)


@query("ar1_forecast_monthly", f"""
with {_MONTHS}, {_ar1("d", 6)}
select step::integer as step, ((select max(ts) from d) + step * interval 1 month)::timestamp as o_orderdate, round(y, 2) as forecast from f
""")
def ar1_forecast_monthly(spark, sf):
    """15.7 forecast of one series without a key, 6 months ahead."""
    f = Ts.ar_forecast(_months(spark, sf), None, "o_orderdate", "y", p=1, horizon=6, step="1 month")
    return f.select("step", "o_orderdate", F.round("forecast", 2).alias("forecast"))


@query("arima111_forecast_monthly", f"""
with recursive {_MONTHS},
w as (select pos, y, y - lag(y) over o as w0, lag(y) over o - lag(y, 2) over o as w1, lag(y, 2) over o - lag(y, 3) over o as w2
      from d window o as (order by pos)),
la as (select regr_slope(w0, w1) as b, regr_intercept(w0, w1) as a from w where pos >= 2),
e as (select w.*, w1 - la.a - la.b * w2 as e1, w0 - la.a - la.b * w1 as e0 from w, la),
c as (select var_pop(w1) as c11, var_pop(e1) as c22, covar_pop(w1, e1) as c12, covar_pop(w0, w1) as y1, covar_pop(w0, e1) as y2,
             avg(w0) as m0, avg(w1) as m1, avg(e1) as m2 from e where pos >= 3),
k as (select (y1 * c22 - y2 * c12) / (c11 * c22 - c12 * c12) as phi, (y2 * c11 - y1 * c12) / (c11 * c22 - c12 * c12) as theta, m0, m1, m2 from c),
z as (select m0 - phi * m1 - theta * m2 as a, phi, theta from k),
n as (select * from e order by pos desc limit 1),
f as (select 1 as step, n.y + z.a + z.phi * n.w0 + z.theta * n.e0 as x, z.a + z.phi * n.w0 + z.theta * n.e0 as w from n, z
      union all select step + 1, x + z.a + z.phi * w, z.a + z.phi * w from f, z where step < 6)
select step, ((select max(ts) from d) + step * interval 1 month)::timestamp as o_orderdate, round(x) as forecast from f
""")
def arima111_forecast_monthly(spark, sf):
    """15.7 ARIMA(1, 1, 1) of one series without a key; residuals from an AR(1)."""
    f = Ts.arima_forecast(_months(spark, sf), None, "o_orderdate", "y", order=(1, 1, 1), horizon=6, long_ar=1, step="1 month")
    return f.select("step", "o_orderdate", F.round("forecast").alias("forecast"))


@query("arima_forecast_by_status", None)
def arima_forecast_by_status(spark, sf):
    """15.7 ARIMA(2, 1, 1) of the monthly totals of every order status, 12 months ahead."""
    m = Ts.resample(T(spark, sf, "orders"), "o_orderdate", "month", {"y": ("sum", "o_totalprice")}, key="o_orderstatus", month_end=False)
    return Ts.arima_forecast(m, "o_orderstatus", "o_orderdate", "y", order=(2, 1, 1), horizon=12, step="1 month")


@query("arima_order_search", None)
def arima_order_search(spark, sf):
    """15.8 best (p, d, q) per type by one-step RMSE on the last fifth."""
    return Ts.arima_select(daily_series(spark, sf), "event_type", "ts", "total", max_p=2, max_d=1, max_q=2, long_ar=3)


@query("ar1_holdout_scores", f"""
with {_MONTHS}, {_ar1("d", 6, "pos < (select count(*) from mo) - 6")},
j as (select d.y as t, f.y as p from f join d on d.pos = f.n + f.step)
select round(avg(abs(t - p)), 2) as mae, round(sqrt(avg((t - p) ** 2)), 2) as rmse, round(avg(abs((t - p) / t)) * 100, 6) as mape from j
""")
def ar1_holdout_scores(spark, sf):
    """15.7 / 14.26 the forecast of the last six months against the truth."""
    from quarry.operators.metrics import reg_metrics

    m = _months(spark, sf)
    cut = m.select(F.add_months(F.max("o_orderdate").cast("date"), -5)).scalar()
    f = Ts.ar_forecast(m.filter(F.col("o_orderdate") < cut), None, "o_orderdate", "y", p=1, horizon=6, step="1 month")
    s = reg_metrics(f.join(m, "o_orderdate"), "y", "forecast")
    return s.select(F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("mape", 6).alias("mape"))


@query("ar_order_search", None)
def ar_order_search(spark, sf):
    """15.8 best AR order per type by one-step RMSE on the last fifth."""
    return Ts.ar_select(daily_series(spark, sf), "event_type", "ts", "total", max_p=5)


@query("history_with_forecast", f"""
with h as ({_DAILY_SQL}),
d as (select event_type as k, ts, total as y, row_number() over (partition by event_type order by ts) - 1 as pos from h),
{_ar1("d", 5)}
select event_type, ts, round(total, 2) as total, null::double as forecast from h
union all
select f.k, l.ts + f.step * interval 1 day, null, round(f.y, 4) from f join (select k, max(ts) as ts from d group by 1) l on l.k = f.k
""")
def history_with_forecast(spark, sf):
    """15.10 forecast attached to the history (8.6 + full join)."""
    hist = daily_series(spark, sf)
    fc = Ts.ar_forecast(hist, "event_type", "ts", "total", p=1, horizon=5, step="1 day")
    out = Ts.attach_forecast(hist, fc.select("event_type", "ts", "forecast"), "event_type", "ts")
    return out.withColumns({"total": F.round("total", 2), "forecast": F.round("forecast", 4)})


@query("demand_forecast_hourly", None)
def demand_forecast_hourly(spark, sf):
    """15.9 hourly demand (event count) from calendar features with
    boosted trees; first 24 days train, the rest test; returns metrics."""
    e = T(spark, sf, "events")
    h = Ts.resample(e, "ts", "hour", {"n": ("count", "event_id")})
    h = h.withColumn("n", F.col("n").cast("double"))
    cut = h.select(F.min("ts")).scalar() + F.expr("interval 24 days")
    _, metrics = Ts.demand_forecast(h.filter(F.col("ts") < cut), h.filter(F.col("ts") >= cut), "ts", "n", rounds=20)
    return metrics
