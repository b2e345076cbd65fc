"""Grouped answers, ranking, sort/top-k, set operators (2.3, 2.5-2.8).

Mapping (SURVEY 7.2): trips -> events (vendor -> event_type, passengers ->
value, pickup -> ts) and lineitem x orders (pickup -> o_orderdate,
dropoff -> l_shipdate); garment/hotel/churn flags -> l_returnflag /
l_linestatus; vehicles -> part.
"""

from pyspark.sql import functions as F

from quarry.operators import aggregate as A
from quarry.operators import filters as Fi
from quarry.operators import ranking as R
from quarry.operators import setops as S
from quarry.plans.registry import T, query

LEVELS_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def r4(c):
    """Large-magnitude means: 4 decimals keep a wide margin over float
    summation-order noise between engines."""
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


# ------------------------------------------------------------ 5.1 - 5.13
@query("events_value_by_type", """
select event_type, round(sum(value), 2) as total_value from events group by event_type
""")
def events_value_by_type(spark, sf):
    """5.1 group sum (money-like measure rounded to cents)."""
    g = A.group_sum(T(spark, sf, "events"), "event_type", ["value"])
    return g.select("event_type", F.round("value", 2).alias("total_value"))


@query("qty_by_flag_status", """
select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty from lineitem group by 1, 2
""")
def qty_by_flag_status(spark, sf):
    """5.1 with two keys."""
    return A.group_sum(T(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity"]).withColumnRenamed(
        "l_quantity", "sum_qty")


@query("discount_mean_by_flag", """
select l_returnflag, round(avg(l_discount), 6) as mean_discount from lineitem group by 1
""")
def discount_mean_by_flag(spark, sf):
    """5.2 group mean."""
    g = A.group_mean(T(spark, sf, "lineitem"), "l_returnflag", ["l_discount"])
    return g.select("l_returnflag", r6("l_discount").alias("mean_discount"))


@query("nonnull_count_by_flag", """
select l_returnflag, count(nullif(l_discount, 0.0)) as n_discounted, count(*) as n_rows
from lineitem group by 1
""")
def nonnull_count_by_flag(spark, sf):
    """5.4 non-NULL count vs 5.5 group size (NULLs injected for zero discounts)."""
    li = T(spark, sf, "lineitem").withColumn("d", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return A.group_agg(li, "l_returnflag", {"n_discounted": F.count("d"), "n_rows": F.count(F.lit(1))})


@query("events_by_type_hour", """
select event_type, hour(ts)::integer as hour, count(*) as n from events group by 1, 2
""")
def events_by_type_hour(spark, sf):
    """5.5 group size on a derived key."""
    e = T(spark, sf, "events").withColumn("hour", F.hour("ts"))
    return A.group_size(e, ["event_type", "hour"])


@query("null_key_groups", """
select nullif(l_returnflag, 'A') as flag, sum(l_quantity) as qty from lineitem
where nullif(l_returnflag, 'A') is not null group by 1
""")
def null_key_groups(spark, sf):
    """T1: pandas drops NULL group keys; ``dropna=True`` does the same."""
    li = T(spark, sf, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("A")))
    return A.group_agg(li, "flag", {"qty": ("sum", "l_quantity")}, dropna=True)


@query("all_null_group_sum", """
select l_returnflag, round(coalesce(sum(case when l_returnflag = 'N' then null else l_tax end), 0), 6) as tax_sum
from lineitem group by 1
""")
def all_null_group_sum(spark, sf):
    """T2: the sum of an all-NULL group is 0, not NULL."""
    li = T(spark, sf, "lineitem").withColumn(
        "t", F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_tax")))
    g = A.group_agg(li, "l_returnflag", {"tax_sum": ("sum", "t")})
    return g.withColumn("tax_sum", F.round("tax_sum", 6))


@query("order_status_profile", """
select o_orderstatus,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
       round(avg(o_totalprice), 4) as mean_price, max(o_totalprice) as max_price,
       min(o_totalprice) as min_price, count(o_orderkey) as n_orders
from orders group by 1
""")
def order_status_profile(spark, sf):
    """5.6 different function per column."""
    o = T(spark, sf, "orders").withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)"))
    g = A.group_agg(o, "o_orderstatus", {
        "total": ("sum", "amt"), "mean_price": ("mean", "o_totalprice"), "max_price": ("max", "o_totalprice"),
        "min_price": ("min", "o_totalprice"), "n_orders": ("count", "o_orderkey")})
    return g.withColumns({"total": F.col("total").cast("double"), "mean_price": r4("mean_price")})


@query("priority_price_matrix", """
select o_orderpriority,
  round(avg(o_totalprice), 4) as o_totalprice_mean, round(quantile_cont(o_totalprice, 0.5), 4) as o_totalprice_median,
  min(o_totalprice) as o_totalprice_min, max(o_totalprice) as o_totalprice_max,
  round(avg(o_custkey), 4) as o_custkey_mean, round(quantile_cont(o_custkey, 0.5), 4) as o_custkey_median,
  min(o_custkey) as o_custkey_min, max(o_custkey) as o_custkey_max
from orders group by 1
""")
def priority_price_matrix(spark, sf):
    """5.7 measures x {mean, median, min, max} by group (median exact, T24)."""
    g = A.group_matrix(T(spark, sf, "orders"), "o_orderpriority", ["o_totalprice", "o_custkey"])
    return g.withColumns({c: r4(c) for c in g.columns if c.endswith(("_mean", "_median"))}).withColumn(
        "o_custkey_median", F.col("o_custkey_median").cast("double"))


@query("status_numeric_means", """
select l_linestatus, round(avg(l_orderkey), 4) as l_orderkey, round(avg(l_partkey), 4) as l_partkey,
  round(avg(l_suppkey), 4) as l_suppkey, round(avg(l_linenumber), 6) as l_linenumber,
  round(avg(l_quantity), 6) as l_quantity, round(avg(l_extendedprice), 4) as l_extendedprice,
  round(avg(l_discount), 6) as l_discount, round(avg(l_tax), 6) as l_tax
from lineitem group by 1
""")
def status_numeric_means(spark, sf):
    """5.8 mean of every numeric column by group (column set from the schema)."""
    g = A.group_mean(T(spark, sf, "lineitem"), "l_linestatus", "numeric")
    big = {"l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"}
    return g.select("l_linestatus", *[(r4(c) if c in big else r6(c)).alias(c) for c in g.columns if c != "l_linestatus"])


@query("discount_rate_by_flag", """
select l_returnflag, round(avg(case when l_discount >= 0.05 then 1.0 else 0.0 end) * 100, 6) as rate_pct
from lineitem group by 1
""")
def discount_rate_by_flag(spark, sf):
    """5.9 group rate of a boolean x 100 (target-reached share by team)."""
    g = A.group_rate(T(spark, sf, "lineitem"), "l_returnflag", F.col("l_discount") >= 0.05)
    return g.withColumn("rate_pct", r6("rate_pct"))


@query("zero_tax_and_age_by_status", """
with ref as (select max(cast(l_shipdate as date)) as m from lineitem)
select l_linestatus, count(*) filter (where l_tax = 0) as n_zero_tax,
  cast(date_diff('day', max(cast(l_shipdate as date)), (select m from ref)) as integer) as days_since_last
from lineitem group by 1
""")
def zero_tax_and_age_by_status(spark, sf):
    """5.10 lambda aggregates: count of zeros; days since the group's max date."""
    li = T(spark, sf, "lineitem")
    ref = li.select(F.max(F.to_date("l_shipdate"))).scalar()
    return A.group_agg(li, "l_linestatus", {
        "n_zero_tax": F.count_if(F.col("l_tax") == 0),
        "days_since_last": F.datediff(ref, F.max(F.to_date("l_shipdate")))})


@query("events_conditional", """
select count(*) filter (where value > 50) as n_big,
  round(coalesce(sum(value) filter (where event_type = 'purchase'), 0), 2) as purchase_value,
  round(avg(value) filter (where event_type = 'error'), 6) as error_mean,
  max(value) filter (where event_type = 'view') as view_max
from events
""")
def events_conditional(spark, sf):
    """5.11 conditional aggregation over predicates in one pass."""
    e = T(spark, sf, "events")
    et = F.col("event_type")
    out = A.agg_where(e, {
        "n_big": ("count", None, F.col("value") > 50), "purchase_value": ("sum", "value", et == "purchase"),
        "error_mean": ("mean", "value", et == "error"), "view_max": ("max", "value", et == "view")})
    return out.withColumns({"purchase_value": F.round("purchase_value", 2), "error_mean": r6("error_mean")})


@query("line_shares", """
select round(avg(case when l_discount > 0 then 1.0 else 0.0 end) * 100, 2) as with_discount,
  round(avg(case when l_tax > 0 then 1.0 else 0.0 end) * 100, 2) as with_tax,
  round(avg(case when l_discount > 0 and l_tax > 0 then 1.0 else 0.0 end) * 100, 2) as with_both
from lineitem
""")
def line_shares(spark, sf):
    """5.12 share of rows with tip / extra / both."""
    li = T(spark, sf, "lineitem")
    d, t = F.col("l_discount") > 0, F.col("l_tax") > 0
    return A.share_of_rows(li, {"with_discount": d, "with_tax": t, "with_both": d & t})


@query("orders_global", """
select round(avg(o_totalprice), 4) as mean_price, max(o_totalprice) as max_price,
  min(o_totalprice) as min_price, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders
""")
def orders_global(spark, sf):
    """5.13 global aggregates."""
    o = T(spark, sf, "orders").withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)"))
    g = A.agg_all(o, {"mean_price": ("mean", "o_totalprice"), "max_price": ("max", "o_totalprice"),
                      "min_price": ("min", "o_totalprice"), "total": ("sum", "amt")})
    return g.withColumns({"mean_price": r4("mean_price"), "total": F.col("total").cast("double")})


@query("priority_value_counts", """
select o_orderpriority, count(*) as count from orders group by 1
""")
def priority_value_counts(spark, sf):
    """5.14 value counts (desc, NULLs dropped)."""
    return A.value_counts(T(spark, sf, "orders"), "o_orderpriority")


@query("priority_shares", """
select o_orderpriority, round(count(*) * 1.0 / (select count(*) from orders), 6) as proportion
from orders group by 1
""")
def priority_shares(spark, sf):
    """5.15 / 6.1 normalised value counts (share of total)."""
    v = A.value_counts(T(spark, sf, "orders"), "o_orderpriority", normalize=True)
    return v.withColumn("proportion", r6("proportion"))


@query("segment_counts_by_nation", """
select c_nationkey, c_mktsegment, count(*) as count from customer group by 1, 2
""")
def segment_counts_by_nation(spark, sf):
    """5.16 value counts within groups."""
    return A.value_counts(T(spark, sf, "customer"), "c_mktsegment", by="c_nationkey")


@query("segment_shares_by_nation", """
select c_nationkey, c_mktsegment,
  round(count(*) * 1.0 / sum(count(*)) over (partition by c_nationkey), 6) as proportion
from customer group by 1, 2
""")
def segment_shares_by_nation(spark, sf):
    """5.15 with ``by``: share within each group."""
    v = A.value_counts(T(spark, sf, "customer"), "c_mktsegment", normalize=True, by="c_nationkey")
    return v.withColumn("proportion", r6("proportion"))


@query("status_priority_crosstab", """
select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2
""")
def status_priority_crosstab(spark, sf):
    """5.17 crosstab (long)."""
    return A.crosstab(T(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("status_priority_wide", """
select o_orderstatus,
  count(*) filter (where o_orderpriority = '1-URGENT') as "1-URGENT",
  count(*) filter (where o_orderpriority = '2-HIGH') as "2-HIGH",
  count(*) filter (where o_orderpriority = '3-MEDIUM') as "3-MEDIUM",
  count(*) filter (where o_orderpriority = '4-NOT SPECIFIED') as "4-NOT SPECIFIED",
  count(*) filter (where o_orderpriority = '5-LOW') as "5-LOW"
from orders group by 1
""")
def status_priority_wide(spark, sf):
    """5.17 crosstab (wide; levels given, so no extra distinct job)."""
    return A.crosstab(T(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", wide=True, levels=LEVELS_PRIORITY)


@query("events_hour_type_pivot", """
select hour(ts)::integer as hour,
  round(sum(value) filter (where event_type = 'click'), 2) as click,
  round(sum(value) filter (where event_type = 'error'), 2) as error,
  round(sum(value) filter (where event_type = 'purchase'), 2) as purchase,
  round(sum(value) filter (where event_type = 'signup'), 2) as signup,
  round(sum(value) filter (where event_type = 'view'), 2) as view
from events group by 1
""")
def events_hour_type_pivot(spark, sf):
    """5.18 pivot (unstack) of a sum; missing cell -> NULL."""
    e = T(spark, sf, "events").withColumn("hour", F.hour("ts"))
    levels = ["click", "error", "purchase", "signup", "view"]
    p = A.pivot(e, "hour", "event_type", "value", "sum", levels)
    return p.select("hour", *[F.round(c, 2).alias(c) for c in levels])


@query("lineitem_nunique", """
select 'l_returnflag' as "column", count(distinct l_returnflag) as nunique from lineitem
union all select 'l_linestatus', count(distinct l_linestatus) from lineitem
union all select 'l_quantity', count(distinct l_quantity) from lineitem
union all select 'l_suppkey', count(distinct l_suppkey) from lineitem
union all select 'l_discount', count(distinct l_discount) from lineitem
""")
def lineitem_nunique(spark, sf):
    """5.19 distinct count per column (exact)."""
    return A.nunique(T(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_suppkey", "l_discount"])


@query("flag_status_distinct", """
select distinct l_returnflag, l_linestatus from lineitem
""")
def flag_status_distinct(spark, sf):
    """5.20 distinct values."""
    return T(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("daily_peak_by_type", """
with d as (
  select event_type, cast(ts as date) as day, round(sum(value), 2) as total from events group by 1, 2
)
select event_type,
  cast(arg_min(day, (-total, day)) as timestamp) as day_at_max, max(total) as total_max,
  cast(arg_min(day, (total, day)) as timestamp) as day_at_min, min(total) as total_min
from d group by 1
""")
def daily_peak_by_type(spark, sf):
    """5.28 arg-max / arg-min per group: busiest and quietest day per type
    (ties -> earliest day)."""
    e = T(spark, sf, "events")
    d = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.round(F.sum("value"), 2).alias("total"))
    p = A.peak(d, "event_type", "day", "total")
    return p.select("event_type", F.col("day_at_max").cast("timestamp_ntz").alias("day_at_max"), "total_max",
                    F.col("day_at_min").cast("timestamp_ntz").alias("day_at_min"), "total_min")


@query("trip_anomalies", """
with t as (
  select o.o_orderstatus as vendor, l.l_extendedprice as fare, l.l_quantity as qty,
         l.l_discount as disc, date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) as gap_days
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
)
select vendor, rule, n_rows, amount from (
  select vendor, 'too_long_cheap' as rule, count(*) filter (where gap_days > 200 and fare < 10000) as n_rows,
         round(coalesce(sum(fare) filter (where gap_days > 200 and fare < 10000), 0), 2) as amount from t group by 1
  union all
  select vendor, 'zero_discount', count(*) filter (where disc = 0),
         round(coalesce(sum(fare) filter (where disc = 0), 0), 2) from t group by 1
  union all
  select vendor, 'same_or_next_day', count(*) filter (where gap_days <= 1),
         round(coalesce(sum(fare) filter (where gap_days <= 1), 0), 2) from t group by 1
  union all
  select vendor, 'negative_gap', count(*) filter (where gap_days < 0),
         round(coalesce(sum(fare) filter (where gap_days < 0), 0), 2) from t group by 1
)
""")
def trip_anomalies(spark, sf):
    """5.34 data-quality anomaly report by vendor, one pass over the join
    (order date = pickup, ship date = dropoff)."""
    from quarry.functions.dates import days_between

    li = T(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", "l_discount", "l_shipdate")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("vendor"), "o_orderdate")
    t = li.join(o, "l_orderkey").withColumn("gap_days", days_between("o_orderdate", "l_shipdate"))
    fare = F.col("l_extendedprice")
    rules = {
        "too_long_cheap": (F.col("gap_days") > 200) & (fare < 10000),
        "zero_discount": F.col("l_discount") == 0,
        "same_or_next_day": F.col("gap_days") <= 1,
        "negative_gap": F.col("gap_days") < 0,
    }
    r = A.anomaly_report(t, rules, amount="l_extendedprice", keys="vendor")
    return r.withColumn("amount", F.round("amount", 2))


@query("price_quantity_trend", """
select round(regr_slope(l_extendedprice, l_quantity), 4) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept from lineitem
""")
def price_quantity_trend(spark, sf):
    """5.33 degree-1 least-squares trend line."""
    t = A.trend(T(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return t.select(r4("slope").alias("slope"), F.round("intercept", 3).alias("intercept"))


@query("mean_price_by_quantity", """
select l_quantity, round(avg(l_extendedprice), 4) as mean_price from lineitem group by 1
""")
def mean_price_by_quantity(spark, sf):
    """5.32 mean line of y per x."""
    g = A.group_mean(T(spark, sf, "lineitem"), "l_quantity", ["l_extendedprice"])
    return g.select("l_quantity", r4("l_extendedprice").alias("mean_price"))


# ----------------------------------------------------------- 3.x filters
@query("filter_conjunctive", """
select * from lineitem where l_returnflag = 'R' and l_linestatus = 'F' and l_quantity = 10
""")
def filter_conjunctive(spark, sf):
    """3.1 conjunctive equality filter (pushed into the scan)."""
    return Fi.where_all(T(spark, sf, "lineitem"), {"l_returnflag": "R", "l_linestatus": "F", "l_quantity": 10.0})


@query("filter_range", """
select l_orderkey, l_linenumber, l_extendedprice from lineitem
where l_extendedprice > 50000 and l_discount <= 0.02 and l_quantity < 30
""")
def filter_range(spark, sf):
    """3.2 range / comparison filter."""
    li = T(spark, sf, "lineitem")
    return Fi.where_all(li, [F.col("l_extendedprice") > 50000, F.col("l_discount") <= 0.02, F.col("l_quantity") < 30]).select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


@query("filter_not_in_keeps_null", """
select count(*) as n_rows, count(p) as n_nonnull from (
  select nullif(o_orderpriority, '3-MEDIUM') as p from orders
) where p is null or p not in ('1-URGENT', '2-HIGH')
""")
def filter_not_in_keeps_null(spark, sf):
    """3.3 ~isin keeps NULL rows (pandas); count() then skips them."""
    o = T(spark, sf, "orders").select(F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("p"))
    f = Fi.isin(o, "p", ["1-URGENT", "2-HIGH"], negate=True)
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.count("p").alias("n_nonnull"))


@query("filter_in_list", """
select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
""")
def filter_in_list(spark, sf):
    """3.3 IN list."""
    return Fi.isin(T(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey", "o_orderpriority")


@query("drop_null_rows", """
select l_orderkey, l_linenumber from (
  select l_orderkey, l_linenumber, nullif(l_discount, 0.0) as d, nullif(l_tax, 0.0) as t from lineitem
) where d is not null and t is not null
""")
def drop_null_rows(spark, sf):
    """3.4 drop rows with any NULL."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("d"),
                                        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("t"))
    return Fi.drop_null_rows(li).select("l_orderkey", "l_linenumber")


@query("iqr_sequential", """
with s0 as (select l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount from lineitem),
q1 as (select quantile_cont(l_extendedprice, 0.25) as a, quantile_cont(l_extendedprice, 0.75) as b from s0),
s1 as (select s0.* from s0, q1 where l_extendedprice between a - 0.5 * (b - a) and b + 0.5 * (b - a)),
q2 as (select quantile_cont(l_quantity, 0.25) as a, quantile_cont(l_quantity, 0.75) as b from s1),
s2 as (select s1.* from s1, q2 where l_quantity between a - 0.5 * (b - a) and b + 0.5 * (b - a)),
q3 as (select quantile_cont(l_discount, 0.25) as a, quantile_cont(l_discount, 0.75) as b from s2),
s3 as (select s2.* from s2, q3 where l_discount between a - 0.5 * (b - a) and b + 0.5 * (b - a))
select l_orderkey, l_linenumber from s3
""")
def iqr_sequential(spark, sf):
    """3.5 sequential Tukey fences (T5), k = 0.5 so every pass removes rows."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount")
    return Fi.iqr_filter(li, ["l_extendedprice", "l_quantity", "l_discount"], k=0.5).select("l_orderkey", "l_linenumber")


@query("head_orders", """
select * from orders order by o_orderdate, o_orderkey limit 5
""")
def head_orders(spark, sf):
    """3.8 head by an explicit key."""
    return Fi.head_by(T(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 5)


@query("tail_orders", """
select * from orders order by o_orderdate desc, o_orderkey desc limit 5
""")
def tail_orders(spark, sf):
    """3.8 tail by an explicit key."""
    return Fi.tail_by(T(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 5)


@query("sample_orders", """
select * from orders order by md5('7:' || o_orderkey::varchar), o_orderkey limit 100
""")
def sample_orders(spark, sf):
    """3.7 seeded sample of n rows (portable md5 order)."""
    return Fi.sample_n(T(spark, sf, "orders"), 100, seed=7, key=["o_orderkey"], method="md5")


# ------------------------------------------------------ 6.x / 7.x ranking
@query("canonical_brand_case", """
with p as (
  select p_partkey, case when p_size < 10 then lower(p_brand)
                         when p_size > 45 then p_brand || '-' || cast(p_partkey as varchar)
                         else p_brand end as brand from part
), c as (select lower(brand) as l, count(*) as n from p group by 1)
select p_partkey, case when c.n > 1 then upper(brand) else brand end as brand
from p join c on lower(p.brand) = c.l
""")
def canonical_brand_case(spark, sf):
    """6.2 / T22: values repeated case-insensitively are upper-cased."""
    p = T(spark, sf, "part")
    b = (F.when(F.col("p_size") < 10, F.lower("p_brand"))
         .when(F.col("p_size") > 45, F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string")))
         .otherwise(F.col("p_brand")))
    return R.canonical_case(p.select("p_partkey", b.alias("brand")), "brand")


@query("brand_rank_top5", """
select * from (
  select p_brand, round(avg(p_retailprice), 6) as score,
         rank() over (order by round(avg(p_retailprice), 6) desc) as rank
  from part group by 1
) where rank <= 5
""")
def brand_rank_top5(spark, sf):
    """6.3 rank of results by score (ties share a rank), top 5 ranks."""
    g = T(spark, sf, "part").groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 6).alias("score"))
    return R.rank_results(g, "score", 5)


@query("ptype_codes", """
select p_partkey, cast(dense_rank() over (order by p_type) - 1 as integer) as p_type_code from part
""")
def ptype_codes(spark, sf):
    """6.6 / 13.1 alphabetical label codes from 0."""
    return R.label_codes(T(spark, sf, "part"), "p_type").select("p_partkey", "p_type_code")


@query("orders_take_range", """
select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 100 offset 100
""")
def orders_take_range(spark, sf):
    """6.7 positional slice [100, 200) in a total order (global numbering
    by range partition + per-partition offsets)."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return R.take_range(o, ["o_orderdate", "o_orderkey"], 100, 200)


@query("orders_rownum_by_customer", """
select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn
from orders
""")
def orders_rownum_by_customer(spark, sf):
    """6.7 per-key row numbers without a key-partitioned window."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return R.per_key_numbers(o, "o_custkey", ["o_orderdate", "o_orderkey"], "rn").select("o_orderkey", "o_custkey", "rn")


@query("sort_by_price_desc", """
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey
""")
def sort_by_price_desc(spark, sf):
    """7.1 / 7.3 sort (range-partitioned)."""
    return R.sort(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], [False, True])


@query("sort_desc_nulls_first", """
select l_orderkey, l_linenumber, nullif(l_tax, 0.0) as tax from lineitem
order by tax desc nulls first
""")
def sort_desc_nulls_first(spark, sf):
    """7.2 / T20 Postgres rule: DESC puts NULLs first."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))
    return R.sort(li, "tax", ascending=False, nulls_first=True)


@query("top10_lines", """
select l_orderkey, l_linenumber, l_extendedprice from lineitem
order by l_extendedprice desc, l_orderkey, l_linenumber limit 10
""")
def top10_lines(spark, sf):
    """7.4 top-n rows with an explicit tie-break (TakeOrderedAndProject)."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return R.top_n(li, "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])


@query("top10_parts_by_qty", """
select l_partkey, sum(l_quantity) as sum_l_quantity from lineitem group by 1
order by 2 desc, 1 limit 10
""")
def top10_parts_by_qty(spark, sf):
    """7.5 top-n groups by an aggregate."""
    return R.top_groups(T(spark, sf, "lineitem"), "l_partkey", "l_quantity", "sum", 10)


@query("first10_brands", """
select p_brand, round(avg(p_retailprice), 6) as mean_p_retailprice from part group by 1 order by 1 limit 10
""")
def first10_brands(spark, sf):
    """7.6 / T3: first ten keys in key order."""
    g = R.first_keys(T(spark, sf, "part"), "p_brand", "p_retailprice", "mean", 10)
    return g.withColumn("mean_p_retailprice", r6("mean_p_retailprice"))


@query("priority_ordinal", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2
  when '4-NOT SPECIFIED' then 3 when '5-LOW' then 4 end as priority_rank from orders
""")
def priority_ordinal(spark, sf):
    """7.7 / 13.4 domain order from a literal level list."""
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", R.ordinal_rank("o_orderpriority", LEVELS_PRIORITY).cast("int").alias("priority_rank"))


# --------------------------------------------------------- 8.x set / struct
@query("union_missing_columns", """
select s_suppkey as id, s_name as name, s_acctbal as acctbal, null::varchar as segment from supplier
union all
select c_custkey, c_name, c_acctbal, c_mktsegment from customer
""")
def union_missing_columns(spark, sf):
    """8.1 union by name; a column missing on one side is NULL."""
    s = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                        F.col("s_acctbal").alias("acctbal"))
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    return S.union(s, c)


@query("duplicate_rows", """
select cast(count(*) - (select count(*) from (select distinct l_returnflag, l_linestatus, l_quantity from lineitem)) as bigint)
  as n_duplicates from lineitem
""")
def duplicate_rows(spark, sf):
    """8.4 rows that repeat an earlier row."""
    return S.duplicate_count(T(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@query("duplicate_flags_count", """
select count(*) filter (where rn > 1) as n_flagged, count(*) as n_rows from (
  select row_number() over (partition by l_returnflag, l_linestatus, l_quantity) as rn from lineitem)
""")
def duplicate_flags_count(spark, sf):
    """8.4 flag form: every copy but one flagged."""
    f = S.duplicate_flags(T(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))
    return f.agg(F.count_if("is_duplicate").alias("n_flagged"), F.count(F.lit(1)).alias("n_rows"))


@query("drop_duplicate_rows", """
select distinct l_returnflag, l_linestatus, l_quantity from lineitem
""")
def drop_duplicate_rows(spark, sf):
    """8.5 drop duplicates."""
    return S.drop_duplicates(T(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@query("monthly_orders_extended", """
with m as (
  select last_day(cast(o_orderdate as date)) as month_end, count(*) as n_orders from orders group by 1
), fut as (
  select last_day(max(month_end) + to_months(k)) as month_end, null::bigint as n_orders
  from m, range(1, 7) t(k) group by k
)
select cast(month_end as timestamp) as month_end, n_orders from (select * from m union all select * from fut)
""")
def monthly_orders_extended(spark, sf):
    """8.6 future frame: six month-end labels after the last month."""
    o = T(spark, sf, "orders")
    m = o.groupBy(F.last_day(F.to_date("o_orderdate")).alias("month_end")).agg(F.count(F.lit(1)).alias("n_orders"))
    out = S.extend_calendar(m, "month_end", 6, unit="month")
    return out.withColumn("month_end", F.col("month_end").cast("timestamp_ntz"))


@query("median_vs_overall", """
with o as (select quantile_cont(c_acctbal, 0.5) as m1, quantile_cont(c_nationkey, 0.5) as m2 from customer)
select c_mktsegment, 'c_acctbal' as "column", round(quantile_cont(c_acctbal, 0.5), 6) as median,
  round((select m1 from o), 6) as overall_median, round(quantile_cont(c_acctbal, 0.5) - (select m1 from o), 6) as diff
from customer group by 1
union all
select c_mktsegment, 'c_nationkey', round(quantile_cont(c_nationkey, 0.5), 6), round((select m2 from o), 6),
  round(quantile_cont(c_nationkey, 0.5) - (select m2 from o), 6)
from customer group by 1
""")
def median_vs_overall(spark, sf):
    """16.6 per-cluster median against the overall median (segments as clusters)."""
    c = T(spark, sf, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("double"))
    m = A.median_vs_overall(c, "c_mktsegment", ["c_acctbal", "c_nationkey"])
    return m.select("c_mktsegment", "column", *[F.round(x, 6).alias(x) for x in ("median", "overall_median", "diff")])


@query("order_value_lags", """
select o_custkey, o_orderkey, o_totalprice,
  lag(o_totalprice, 1) over w as o_totalprice_lag_1, lag(o_totalprice, 2) over w as o_totalprice_lag_2
from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)
""")
def order_value_lags(spark, sf):
    """6.4 lagged features per customer ordered by date (global position
    join, no key-partitioned window)."""
    o = T(spark, sf, "orders").withColumn("ord", F.struct("o_orderdate", "o_orderkey"))
    out = R.lags(o.select("o_custkey", "o_orderkey", "o_totalprice", "ord"), "o_custkey", "ord", "o_totalprice", 2)
    return out.select("o_custkey", "o_orderkey", "o_totalprice", "o_totalprice_lag_1", "o_totalprice_lag_2")


@query("daily_centred_average", """
with d as (select event_type, cast(ts as date) as day, sum(value) as total from events group by 1, 2)
select event_type, cast(day as timestamp) as day, round(total, 6) as total,
  round((0.5 * lag(total, 2) over w + lag(total, 1) over w + total + lead(total, 1) over w
         + 0.5 * lead(total, 2) over w) / 4, 6) as trend
from d window w as (partition by event_type order by day)
""")
def daily_centred_average(spark, sf):
    """6.5 centred moving average, even period 4 (2x4 MA: end weights 1/2)."""
    e = T(spark, sf, "events")
    d = e.groupBy("event_type", F.to_date("ts").cast("timestamp_ntz").alias("day")).agg(F.sum("value").alias("total"))
    m = R.moving_average(d, "event_type", "day", "total", 4)
    return m.select("event_type", "day", F.round("total", 6).alias("total"), F.round("trend", 6).alias("trend"))


@query("train_test_union", f"""
select *, {"(('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::ubigint % 100)"} < 80 as is_train from orders
""")
def train_test_union(spark, sf):
    """8.2 union of the train and test parts back into one table (by name)."""
    from quarry.operators.features import split

    o = T(spark, sf, "orders")
    tr, te = split(o, "o_orderkey", 0.8, method="md5")
    return S.union(tr.withColumn("is_train", F.lit(True)), te.withColumn("is_train", F.lit(False)))
