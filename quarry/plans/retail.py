"""Retail star-schema answers (Q1-Q4, joins 2.4, RFM).

Mapping (SURVEY 7.2): transaction -> lineitem (+ orders for the date),
store -> supplier, product -> part, customer -> customer
(marital status -> c_mktsegment, age/income -> c_acctbal).
"""

from pyspark.sql import functions as F

from quarry.functions.dates import recency
from quarry.operators import aggregate as A
from quarry.operators import joins as J
from quarry.operators.features import rfm
from quarry.plans.registry import T, query

MONEY = "decimal(18,2)"


def money_sum(col: str):
    """Exact money total (decimal accumulation, reported as double)."""
    return F.sum(F.col(col).cast(MONEY)).cast("double")


@query("store_qty", """
select s.s_name, sum(l.l_quantity) as total_qty
from supplier s join lineitem l on s.s_suppkey = l.l_suppkey
group by s.s_name order by total_qty desc nulls first, s.s_name
""")
def store_qty(spark, sf):
    """Q3: total quantity per store name, largest first."""
    li = T(spark, sf, "lineitem").select(F.col("l_suppkey").alias("suppkey"), "l_quantity")
    su = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_name")
    return J.dimension_totals(li, su, "suppkey", "s_name", "l_quantity", "total_qty")


@query("product_amount", """
select p.p_name, cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) as total_amount
from part p join lineitem l on p.p_partkey = l.l_partkey
group by p.p_name order by total_amount desc nulls first, p.p_name
""")
def product_amount(spark, sf):
    """Q4: total amount per product name (names repeat across keys)."""
    li = T(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"),
                                         F.col("l_extendedprice").cast(MONEY).alias("amt"))
    pa = T(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), "p_name")
    out = J.dimension_totals(li, pa, "partkey", "p_name", "amt", "total_amount")
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("avg_balance_by_segment", """
select round(avg(c_acctbal), 4) as avg_acctbal, c_mktsegment from customer group by c_mktsegment
""")
def avg_balance_by_segment(spark, sf):
    """Q1: SQL group average; SQL keeps a NULL group (dropna=False)."""
    c = T(spark, sf, "customer")
    return A.group_mean(c, "c_mktsegment", ["c_acctbal"], dropna=False).select(
        F.round("c_acctbal", 4).alias("avg_acctbal"), "c_mktsegment")


@query("avg_balance_by_nation", """
select round(avg(c_acctbal), 4) as avg_acctbal, c_nationkey from customer group by c_nationkey
""")
def avg_balance_by_nation(spark, sf):
    """Q2: the same shape on a second key."""
    c = T(spark, sf, "customer")
    return A.group_mean(c, "c_nationkey", ["c_acctbal"], dropna=False).select(
        F.round("c_acctbal", 4).alias("avg_acctbal"), "c_nationkey")


@query("star_join_segment_type", """
select c.c_mktsegment, p.p_type, count(*) as n_lines, sum(l.l_quantity) as qty,
       cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) as amount
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
join part p on l.l_partkey = p.p_partkey
join supplier s on l.l_suppkey = s.s_suppkey
group by c.c_mktsegment, p.p_type
""")
def star_join_segment_type(spark, sf):
    """Op 4.1/4.2: fact x orders x customer x part x supplier (master
    table), then a grouped answer. Dimensions are broadcast behind a row
    bound; orders is a fact-sized table and is joined by shuffle."""
    li = T(spark, sf, "lineitem")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    master = J.star_join(li.join(o, "l_orderkey"), [
        (T(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey"),
        (T(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey"),
        (T(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey"),
    ])
    return master.groupBy("c_mktsegment", "p_type").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"), money_sum("l_extendedprice").alias("amount"))


@query("orders_left_join_lines", """
select o.o_orderkey, count(l.l_orderkey) as n_lines
from orders o left join lineitem l on o.o_orderkey = l.l_orderkey
group by o.o_orderkey
""")
def orders_left_join_lines(spark, sf):
    """Op 4.4: left join keeps orders without lines (count 0). Lines are
    pre-aggregated per order before the join (map-side combine)."""
    o = T(spark, sf, "orders").select("o_orderkey")
    per = T(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return J.left_join(o, per, "o_orderkey").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"))


@query("customer_rfm", """
with s as (
  select o_custkey, cast(o_orderdate as date) as d, o_orderkey, o_totalprice from orders
), ref as (select max(d) + interval 2 day as r from s)
select o_custkey,
       cast(date_diff('day', max(d), (select cast(r as date) from ref)) as integer) as recency,
       count(distinct o_orderkey) as frequency,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as monetary
from s group by o_custkey
""")
def customer_rfm(spark, sf):
    """Op 13.8 / 4.5 / 10.8: RFM in one aggregation."""
    o = T(spark, sf, "orders").withColumn("amt", F.col("o_totalprice").cast(MONEY))
    out = rfm(o, "o_custkey", "o_orderdate", "o_orderkey", "amt")
    return out.withColumn("monetary", F.col("monetary").cast("double"))


@query("customer_recency", """
with s as (select o_custkey, cast(o_orderdate as date) as d from orders),
ref as (select max(d) + interval 2 day as r from s)
select o_custkey, cast(date_diff('day', max(d), (select cast(r as date) from ref)) as integer) as recency
from s group by o_custkey
""")
def customer_recency(spark, sf):
    """Op 10.8: days since each customer's last order, reference = max + 2."""
    return recency(T(spark, sf, "orders"), "o_custkey", "o_orderdate", 2)


@query("customer_purchase_features", """
select o.o_custkey, count(l.l_orderkey) as n_transactions, sum(l.l_quantity) as total_qty,
       cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) as total_amount
from lineitem l join orders o on l.l_orderkey = o.o_orderkey group by o.o_custkey
""")
def customer_purchase_features(spark, sf):
    """Op 13.9: per-customer transaction count, quantity and amount.

    Lines are first reduced to one row per order (partial + final
    aggregate keyed by the join key), so the fact-to-fact join with orders
    shuffles orders-many rows instead of lines-many; the customer totals
    then add up the per-order partial sums."""
    li = T(spark, sf, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count("l_orderkey").alias("n"), F.sum("l_quantity").alias("q"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("a"))
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = per_order.join(o, "l_orderkey")
    # customer_features' (count, sum, sum) re-aggregated from the per-order partials
    return j.groupBy("o_custkey").agg(F.sum("n").alias("n_transactions"), F.sum("q").alias("total_qty"),
                                      F.sum("a").cast("double").alias("total_amount"))


@query("part_price_lookup", """
with f as (select p_type, count(*) * 1.0 / (select count(*) from part) as share from part group by p_type)
select l.l_orderkey, l.l_linenumber, f.share as p_type_share
from lineitem l join part p on l.l_partkey = p.p_partkey join f on p.p_type = f.p_type
""")
def part_price_lookup(spark, sf):
    """Op 4.7 / 13.3: value -> frequency lookup attached by a join."""
    from quarry.operators.features import fit_freq_encoder

    part = T(spark, sf, "part")
    enc = fit_freq_encoder(part, ["p_type"])
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = enc.transform(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"))
    return li.join(p, "l_partkey").select("l_orderkey", "l_linenumber", "p_type_freq").withColumnRenamed(
        "p_type_freq", "p_type_share")
