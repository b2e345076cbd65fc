"""String, date/time, math and conditional scalars (2.9-2.11, 2.16)."""

from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import numeric as N
from quarry.functions import strings as St
from quarry.plans.registry import T, query


@query("string_scalars", """
select p_partkey, upper(p_name) as name_upper, lower(p_brand) as brand_lower,
  replace(p_brand, 'Brand#', 'B-') as brand_short, concat_ws(' #', p_type, cast(p_size as varchar)) as type_size
from part
""")
def string_scalars(spark, sf):
    """9.1 upper/lower, 9.2 literal replace, 9.5 concat label + number."""
    p = T(spark, sf, "part")
    return p.select("p_partkey", F.upper("p_name").alias("name_upper"), F.lower("p_brand").alias("brand_lower"),
                    St.replace_text("p_brand", "Brand#", "B-").alias("brand_short"),
                    St.concat_label(" #", "p_type", "p_size").alias("type_size"))


@query("recode_keep_vs_null", """
select o_orderkey,
  case o_orderstatus when 'F' then 'filled' when 'O' then 'open' else o_orderstatus end as status_replaced,
  case o_orderstatus when 'F' then 'filled' when 'O' then 'open' end as status_mapped
from orders
""")
def recode_keep_vs_null(spark, sf):
    """9.3 replace (unmatched kept) vs 9.4 map (unmatched -> NULL), T11."""
    o = T(spark, sf, "orders")
    m = {"F": "filled", "O": "open"}
    return o.select("o_orderkey", St.replace_values("o_orderstatus", m).alias("status_replaced"),
                    St.map_values("o_orderstatus", m).alias("status_mapped"))


@query("frame_replace_trailing", """
select c_custkey, case when c_mktsegment = 'BUILDING ' then 'BUILDING' else c_mktsegment end as seg,
  case when c_name = 'BUILDING ' then 'BUILDING' else c_name end as c_name
from (select c_custkey, case when c_nationkey < 5 then c_mktsegment || ' ' else c_mktsegment end as c_mktsegment,
      c_name from customer)
""")
def frame_replace_trailing(spark, sf):
    """T12: whole-value replace over every string column of the frame
    (the ``'finishing '`` trailing-space fix)."""
    c = T(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") < 5, F.concat("c_mktsegment", F.lit(" "))).otherwise(
            F.col("c_mktsegment")).alias("c_mktsegment"), "c_name")
    out = St.replace_values_frame(c, {"BUILDING ": "BUILDING"})
    return out.withColumnRenamed("c_mktsegment", "seg")


@query("recode_by_table", """
with m as (select distinct p_type as from_value, lower(substr(p_type, 1, 3)) as to_value from part where p_size > 40)
select p_partkey, coalesce(m.to_value, p.p_type) as p_type from part p left join m on p.p_type = m.from_value
""")
def recode_by_table(spark, sf):
    """9.6 canonicalisation through a mapping *table* (derived here from the
    part table itself), joined behind a checked broadcast bound."""
    p = T(spark, sf, "part")
    m = p.filter(F.col("p_size") > 40).select(F.col("p_type").alias("from_value"),
                                              F.lower(F.substring("p_type", 1, 3)).alias("to_value")).distinct()
    return St.recode(p.select("p_partkey", "p_type"), "p_type", m)


@query("parse_format_ts", """
select o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M') as shown,
  strptime(strftime(o_orderdate, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') as parsed
from orders
""")
def parse_format_ts(spark, sf):
    """10.1 parse and 10.2 format timestamps (round trip)."""
    o = T(spark, sf, "orders")
    shown = D.format_ts("o_orderdate", "dd/MM/yyyy HH:mm")
    return o.select("o_orderkey", shown.alias("shown"), D.parse_ts(shown, "dd/MM/yyyy HH:mm").alias("parsed"))


@query("parse_month_year", """
with s as (
  select o_orderkey, case when o_orderstatus = 'P' then 'n/a' else strftime(o_orderdate, '%b-%y') end as s from orders
)
select o_orderkey, s,
  coalesce(strftime(try_strptime(s, '%b-%y'), '%m'), '') as s_month,
  coalesce(strftime(try_strptime(s, '%b-%y'), '%Y'), '') as s_year
from s
""")
def parse_month_year(spark, sf):
    """10.3 / 16.1 'Mon-yy' -> month and four-digit year; two-digit years
    pivot at 69 (T13); failures -> '' (T14)."""
    o = T(spark, sf, "orders")
    s = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.date_format("o_orderdate", "MMM-yy"))
    return o.select("o_orderkey", s.alias("s")).withColumns(D.parse_month_year("s"))


@query("calendar_features", """
select event_id, hour(ts)::integer as hour, (isodow(ts) - 1)::integer as dayofweek, quarter(ts)::integer as quarter,
  month(ts)::integer as month, year(ts)::integer as year, dayofyear(ts)::integer as dayofyear,
  day(ts)::integer as dayofmonth, weekofyear(ts)::integer as weekofyear
from events
""")
def calendar_features(spark, sf):
    """10.4 / 16.2 calendar features (Monday = 0, ISO week), one projection."""
    e = T(spark, sf, "events").select("event_id", "ts")
    return D.calendar_features(e, "ts").drop("ts")


@query("date_parts", """
select o_orderkey, dayname(o_orderdate) as weekday_name, cast(cast(o_orderdate as date) as timestamp) as day,
  year(o_orderdate)::integer as year, month(o_orderdate)::integer as month, monthname(o_orderdate) as month_name
from orders
""")
def date_parts(spark, sf):
    """10.5 weekday name, date, year, month, month name."""
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", D.date_part("o_orderdate", "weekday_name").alias("weekday_name"),
                    D.date_part("o_orderdate", "date").cast("timestamp_ntz").alias("day"),
                    D.date_part("o_orderdate", "year").alias("year"), D.date_part("o_orderdate", "month").alias("month"),
                    D.date_part("o_orderdate", "month_name").alias("month_name"))


@query("day_and_minute_gaps", """
select l.l_orderkey, l.l_linenumber,
  date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date))::integer as gap_days,
  (epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 6.0e7 as gap_minutes
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
""")
def day_and_minute_gaps(spark, sf):
    """10.6 day gap (calendar dates) and exact minute gap (T18)."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber", D.days_between("o_orderdate", "l_shipdate").alias("gap_days"),
                    D.minutes_between("o_orderdate", "l_shipdate").alias("gap_minutes"))


@query("event_minutes_into_day", """
select event_id, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 6.0e7 as minutes from events
""")
def event_minutes_into_day(spark, sf):
    """10.6 minute gap with sub-second precision."""
    e = T(spark, sf, "events")
    return e.select("event_id", D.minutes_between(F.date_trunc("day", "ts"), F.col("ts")).alias("minutes"))


@query("add_days_months", """
select o_orderkey, cast(cast(o_orderdate as date) + 30 as timestamp) as plus_30d,
  cast(cast(o_orderdate as date) + interval 1 month as timestamp) as plus_1m,
  cast(last_day(cast(o_orderdate as date)) + interval 1 month as timestamp) as month_end_plus_1m
from orders
""")
def add_days_months(spark, sf):
    """10.7 add days / months (month ends clip to the shorter month)."""
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", D.add_days("o_orderdate", 30).cast("timestamp_ntz").alias("plus_30d"),
                    D.add_months("o_orderdate", 1).cast("timestamp_ntz").alias("plus_1m"),
                    D.add_months(F.last_day("o_orderdate"), 1).cast("timestamp_ntz").alias("month_end_plus_1m"))


@query("math_scalars", """
select c_custkey, abs(c_acctbal) as abs_bal, floor(c_acctbal / 365)::bigint as years_floor,
  c_acctbal / 10000.0 * 100.0 as pct_of_10k, round(sqrt(abs(c_acctbal)), 6) as sqrt_bal,
  c_acctbal >= 0 as solvent, case when c_acctbal < 0 then 1 else 0 end as in_debt,
  case when c_mktsegment in ('AUTOMOBILE', 'MACHINERY') then 1 else 0 end as target
from customer
""")
def math_scalars(spark, sf):
    """11.1 abs, 11.2 floor division (T17), 11.3 round/pct/sqrt, 11.4
    comparison, 11.5 flag, 11.6 target label."""
    c = N.abs_columns(T(spark, sf, "customer").withColumn("abs_bal", F.col("c_acctbal")), ["abs_bal"])
    return c.select("c_custkey", "abs_bal", N.floor_div("c_acctbal", 365).alias("years_floor"),
                    N.pct("c_acctbal", 10000.0, None).alias("pct_of_10k"), F.round(F.sqrt("abs_bal"), 6).alias("sqrt_bal"),
                    N.compare("c_acctbal", ">=", 0).alias("solvent"), N.flag(F.col("c_acctbal") < 0).alias("in_debt"),
                    N.label_target("c_mktsegment", ["AUTOMOBILE", "MACHINERY"]).alias("target"))


@query("per_column_transform", """
select l_orderkey, l_linenumber, abs(l_quantity - 25) as l_quantity, round(abs(l_discount - 0.05), 6) as l_discount
from lineitem
""")
def per_column_transform(spark, sf):
    """16.5 the same expression over a column list, one projection."""
    li = T(spark, sf, "lineitem").withColumns({"l_quantity": F.col("l_quantity") - 25,
                                              "l_discount": F.col("l_discount") - 0.05})
    return N.abs_columns(li, ["l_quantity", "l_discount"]).select("l_orderkey", "l_linenumber", "l_quantity",
                                                                   F.round("l_discount", 6).alias("l_discount"))
