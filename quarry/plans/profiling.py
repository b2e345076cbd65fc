"""Profiles, schema-driven projections and missing data (2.2, 2.12, 5.19-5.31)."""

from pyspark.sql import functions as F

from quarry.operators import missing as M
from quarry.operators import profile as P
from quarry.operators import schema as Sc
from quarry.plans.registry import T, query


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _lineitem_with_gaps(spark, sf):
    """lineitem with NULLs injected by value rules (test tables have none)."""
    li = T(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") >= 3, None).otherwise(F.col("l_tax")).alias("tax_sparse"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
        F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag")).alias("flag"),
        F.lit(None).cast("double").alias("all_null"),
        F.lit("x").alias("constant"),
    )


_GAPS_SQL = """
select l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  case when l_linenumber >= 3 then null else l_tax end as tax_sparse,
  nullif(l_discount, 0.0) as discount,
  case when l_returnflag = 'N' then null else l_returnflag end as flag,
  null::double as all_null, 'x' as constant
from lineitem
"""


@query("drop_sparse_columns", f"""
with g as ({_GAPS_SQL})
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, discount, flag, constant from g
""")
def drop_sparse_columns(spark, sf):
    """2.8 drop columns more than 45 % NULL (decided by one aggregate pass)."""
    return Sc.drop_sparse(_lineitem_with_gaps(spark, sf), 45.0)


@query("drop_constant_columns", f"""
with g as ({_GAPS_SQL})
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, tax_sparse, discount, flag from g
""")
def drop_constant_columns(spark, sf):
    """2.9 drop all-NULL and single-valued columns."""
    return Sc.drop_constant(_lineitem_with_gaps(spark, sf))


@query("collinear_lineitem", """
with t as (select l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) as net, l_discount from lineitem)
select a, b, r from (
  select 'l_quantity' as a, 'l_extendedprice' as b, round(corr(l_quantity, l_extendedprice), 6) as r from t
  union all select 'l_quantity', 'net', round(corr(l_quantity, net), 6) from t
  union all select 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) from t
  union all select 'l_extendedprice', 'net', round(corr(l_extendedprice, net), 6) from t
  union all select 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) from t
  union all select 'net', 'l_discount', round(corr(net, l_discount), 6) from t
) where abs(r) >= 0.9
""")
def collinear_lineitem(spark, sf):
    """2.10 collinear pairs (|r| >= 0.9) from the long correlation matrix."""
    li = T(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    c = Sc.collinear_pairs(li, ["l_quantity", "l_extendedprice", "net", "l_discount"], 0.9)
    return c.withColumn("r", r6("r"))


@query("schema_projection_ops", """
select o_orderkey as order_id, o_totalprice as price, cast(trunc(o_totalprice) as bigint) as price_int,
  o_custkey, o_orderstatus from orders
""")
def schema_projection_ops(spark, sf):
    """2.1 select, 2.2 drop, 2.3 rename, 2.4 move, 2.5 cast, 2.12 derived column."""
    o = T(spark, sf, "orders")
    o = Sc.drop(o, ["o_orderdate", "o_orderpriority"])
    o = Sc.rename(o, {"o_orderkey": "order_id", "o_totalprice": "price"})
    o = Sc.with_column(o, "price_int", F.col("price").cast("bigint"))
    o = Sc.move_column(o, "price_int", 2)
    o = Sc.move_column(o, "price", 1)
    return Sc.select(o, ["order_id", "price", "price_int", "o_custkey", "o_orderstatus"])


@query("columns_by_type", """
select 'numeric' as kind, count(*) as n_rows,
  count(l_orderkey) + count(l_partkey) + count(l_suppkey) + count(l_linenumber) + count(l_quantity)
  + count(l_extendedprice) + count(l_discount) + count(l_tax) as n_values, 8 as n_columns from lineitem
union all
select 'other', count(*), count(l_returnflag) + count(l_linestatus) + count(l_shipdate), 3 from lineitem
""")
def columns_by_type(spark, sf):
    """2.6 / 2.7 / 2.11 column sets chosen from the schema, then used: the
    non-NULL cells of each set and the table shape, one pass."""
    li = T(spark, sf, "lineitem")
    out = None
    for kind in ("numeric", "other"):
        cols = Sc.columns_of(li, kind)
        cells = sum((F.count(c) for c in cols[1:]), F.count(cols[0]))
        part = li.agg(F.count(F.lit(1)).alias("n_rows"), cells.alias("n_values")).select(
            F.lit(kind).alias("kind"), "n_rows", "n_values", F.lit(len(cols)).alias("n_columns"))
        out = part if out is None else out.unionByName(part)
    return out


@query("describe_lineitem", """
select "column", count, round(mean, 4) as mean, round(std, 4) as std, min, round(q25, 4) as q25,
  round(q50, 4) as q50, round(q75, 4) as q75, max from (
  select 'l_quantity' as "column", count(l_quantity) as count, avg(l_quantity) as mean, stddev_samp(l_quantity) as std,
    min(l_quantity) as min, quantile_cont(l_quantity, 0.25) as q25, quantile_cont(l_quantity, 0.5) as q50,
    quantile_cont(l_quantity, 0.75) as q75, max(l_quantity) as max from lineitem
  union all
  select 'l_extendedprice', count(l_extendedprice), avg(l_extendedprice), stddev_samp(l_extendedprice),
    min(l_extendedprice), quantile_cont(l_extendedprice, 0.25), quantile_cont(l_extendedprice, 0.5),
    quantile_cont(l_extendedprice, 0.75), max(l_extendedprice) from lineitem
  union all
  select 'l_discount', count(l_discount), avg(l_discount), stddev_samp(l_discount), min(l_discount),
    quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75), max(l_discount)
  from lineitem
)
""")
def describe_lineitem(spark, sf):
    """5.23 numeric profile, one pass, long form (sample std, exact quartiles)."""
    d = P.describe_numeric(T(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return d.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query("describe_orders_categorical", """
with pairs as (
  select 'o_orderstatus' as "column", o_orderstatus as value from orders
  union all select 'o_orderpriority', o_orderpriority from orders
), vc as (select "column", value, count(*) as n from pairs group by 1, 2)
select "column", sum(n)::bigint as count, count(*) as unique, arg_min(value, (-n, value)) as top, max(n) as freq
from vc group by 1
""")
def describe_orders_categorical(spark, sf):
    """5.24 categorical profile (top ties -> smallest value)."""
    return P.describe_categorical(T(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]).withColumn(
        "count", F.col("count").cast("long"))


@query("null_profile_gaps", f"""
with g as ({_GAPS_SQL}), n as (select count(*) as n from g)
select "column", n_null, round(n_null * 100.0 / (select n from n), 6) as pct_null from (
  select 'l_orderkey' as "column", count(*) filter (where l_orderkey is null) as n_null from g
  union all select 'l_linenumber', count(*) filter (where l_linenumber is null) from g
  union all select 'l_quantity', count(*) filter (where l_quantity is null) from g
  union all select 'l_extendedprice', count(*) filter (where l_extendedprice is null) from g
  union all select 'tax_sparse', count(*) filter (where tax_sparse is null) from g
  union all select 'discount', count(*) filter (where discount is null) from g
  union all select 'flag', count(*) filter (where flag is null) from g
  union all select 'all_null', count(*) filter (where all_null is null) from g
  union all select 'constant', count(*) filter (where constant is null) from g
)
""")
def null_profile_gaps(spark, sf):
    """5.25 / 8.3 null count and share per column."""
    p = P.null_profile(_lineitem_with_gaps(spark, sf))
    return p.withColumn("pct_null", r6("pct_null"))


@query("has_nulls_check", f"""
with g as ({_GAPS_SQL})
select (select count(*) > 0 from g where discount is null) as with_gaps,
       (select count(*) > 0 from orders where o_orderkey is null or o_custkey is null or o_orderstatus is null
          or o_totalprice is null or o_orderdate is null or o_orderpriority is null) as orders_gaps
""")
def has_nulls_check(spark, sf):
    """5.26 any-NULL test (a driver-side boolean, returned as a row)."""
    a = P.has_nulls(_lineitem_with_gaps(spark, sf).select("discount"))
    b = P.has_nulls(T(spark, sf, "orders"))
    return spark.createDataFrame([(a, b)], "with_gaps boolean, orders_gaps boolean")


@query("price_quantiles_by_status", """
select o_orderstatus, prob, round(value, 4) as value from (
  select o_orderstatus, 0.1::double as prob, quantile_cont(o_totalprice, 0.1) as value from orders group by 1
  union all select o_orderstatus, 0.5::double, quantile_cont(o_totalprice, 0.5) from orders group by 1
  union all select o_orderstatus, 0.9::double, quantile_cont(o_totalprice, 0.9) from orders group by 1
)
""")
def price_quantiles_by_status(spark, sf):
    """5.27 linear-interpolated quantiles per group (T4)."""
    q = P.quantiles(T(spark, sf, "orders"), "o_totalprice", [0.1, 0.5, 0.9], keys="o_orderstatus")
    return q.withColumn("value", F.round("value", 4))


@query("price_quantiles_sort", """
with o as (select nullif(o_orderstatus, 'F') as s, o_totalprice from orders)
select s, prob, round(value, 4) as value from (
  select s, 0.1::double as prob, quantile_cont(o_totalprice, 0.1) as value from o group by 1
  union all select s, 0.5::double, quantile_cont(o_totalprice, 0.5) from o group by 1
  union all select s, 0.9::double, quantile_cont(o_totalprice, 0.9) from o group by 1
)
""")
def price_quantiles_sort(spark, sf):
    """5.27 by ranks, as for columns with very many values, with a NULL group."""
    o = T(spark, sf, "orders").select(F.nullif("o_orderstatus", F.lit("F")).alias("s"), "o_totalprice")
    q = P.quantiles(o, "o_totalprice", [0.1, 0.5, 0.9], keys="s", method="sort")
    return q.withColumn("value", F.round("value", 4))


def _wide_embeddings(spark, sf):
    """105 numeric columns: 64 components and 41 products of neighbours, some with NULLs."""
    e = T(spark, sf, "embeddings")
    x = lambda i: F.col("embedding")[i].cast("double")
    gap = lambda c, i: F.when(F.col("vec_id") % (i % 9 + 4) != 0, c) if i % 3 == 0 else c
    cols = [gap(x(i), i).alias(f"c{i:03d}") for i in range(64)]
    return e.select(*cols, *[gap(x(i) * x(i + 1), i + 64).alias(f"c{i + 64:03d}") for i in range(41)])


@query("corr_wide_embeddings", """
with e as (select vec_id, unnest(range(105)) as i, embedding::DOUBLE[] as x from embeddings),
v as (select vec_id, i, case when i < 64 then x[i + 1] else x[i - 63] * x[i - 62] end as c from e
      where i % 3 <> 0 or vec_id % (i % 9 + 4) <> 0)
select 'c' || lpad(p.i::varchar, 3, '0') as a, 'c' || lpad(q.i::varchar, 3, '0') as b, round(corr(p.c, q.c), 6) as r
from v p join v q on p.vec_id = q.vec_id and p.i < q.i group by p.i, q.i
""")
def corr_wide_embeddings(spark, sf):
    """5.22 all 5,460 correlations of 105 columns with NULLs, pairwise-complete."""
    wide = _wide_embeddings(spark, sf)
    return P.corr_long(wide, wide.columns).withColumn("r", r6("r"))


@query("collinear_wide_embeddings", """
with e as (select vec_id, unnest(range(105)) as i, embedding::DOUBLE[] as x from embeddings),
v as (select vec_id, i, case when i < 64 then x[i + 1] else x[i - 63] * x[i - 62] end as c from e
      where i % 3 <> 0 or vec_id % (i % 9 + 4) <> 0)
select * from (
  select 'c' || lpad(p.i::varchar, 3, '0') as a, 'c' || lpad(q.i::varchar, 3, '0') as b, round(corr(p.c, q.c), 6) as r
  from v p join v q on p.vec_id = q.vec_id and p.i < q.i group by p.i, q.i) where abs(r) >= 0.05
""")
def collinear_wide_embeddings(spark, sf):
    """2.10 the pairs of 105 columns with |r| >= 0.05."""
    wide = _wide_embeddings(spark, sf)
    return P.corr_long(wide, wide.columns).withColumn("r", r6("r")).filter("abs(r) >= 0.05")


@query("corr_with_target", """
select 'l_extendedprice' as a, b, round(r, 6) as r from (
  select 'l_quantity' as b, corr(l_extendedprice, l_quantity) as r from lineitem
  union all select 'l_discount', corr(l_extendedprice, l_discount) from lineitem
  union all select 'l_tax', corr(l_extendedprice, l_tax) from lineitem
  union all select 'l_linenumber', corr(l_extendedprice, l_linenumber) from lineitem
)
""")
def corr_with_target(spark, sf):
    """5.22 correlations ranked against a target column."""
    c = P.corr_long(T(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"],
                    target="l_extendedprice")
    return c.withColumn("r", r6("r"))


@query("price_histogram", """
with s as (select min(o_totalprice) as mn, max(o_totalprice) as mx from orders),
b as (select least(floor((o_totalprice - mn) / ((mx - mn) / 10.0)), 9)::integer as bin from orders, s),
c as (select bin, count(*) as n from b group by 1)
select r.bin::integer as bin, round(mn + r.bin * (mx - mn) / 10.0, 6) as lo,
  round(case when r.bin = 9 then mx else mn + (r.bin + 1) * (mx - mn) / 10.0 end, 6) as hi,
  coalesce(c.n, 0) as n
from range(10) r(bin) cross join s left join c on c.bin = r.bin
""")
def price_histogram(spark, sf):
    """5.29 equal-width histogram, every bin present."""
    h = P.histogram(T(spark, sf, "orders"), "o_totalprice", 10)
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi")})


@query("price_histogram_by_status", """
with s as (select min(o_totalprice) as mn, max(o_totalprice) as mx from orders),
b as (select o_orderstatus, least(floor((o_totalprice - mn) / ((mx - mn) / 5.0)), 4)::integer as bin from orders, s),
c as (select o_orderstatus, bin, count(*) as n from b group by 1, 2),
k as (select distinct o_orderstatus from orders)
select k.o_orderstatus, r.bin::integer as bin, round(mn + r.bin * (mx - mn) / 5.0, 6) as lo,
  round(case when r.bin = 4 then mx else mn + (r.bin + 1) * (mx - mn) / 5.0 end, 6) as hi, coalesce(c.n, 0) as n
from k cross join range(5) r(bin) cross join s left join c on c.bin = r.bin and c.o_orderstatus = k.o_orderstatus
""")
def price_histogram_by_status(spark, sf):
    """5.29 histogram split by class on common bins."""
    h = P.histogram(T(spark, sf, "orders"), "o_totalprice", 5, by="o_orderstatus")
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi")})


@query("box_stats_by_flag", """
with q as (
  select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.5) as med,
         quantile_cont(l_extendedprice, 0.75) as q3 from lineitem group by 1
), f as (select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
select f.l_returnflag, 'l_extendedprice' as "column", round(q1, 6) as q1, round(med, 6) as median, round(q3, 6) as q3,
  round(lo, 6) as lower_fence, round(hi, 6) as upper_fence,
  min(l_extendedprice) filter (where l_extendedprice >= lo) as whisker_low,
  max(l_extendedprice) filter (where l_extendedprice <= hi) as whisker_high,
  count(*) filter (where l_extendedprice < lo or l_extendedprice > hi) as n_outliers
from lineitem l join f on l.l_returnflag = f.l_returnflag
group by f.l_returnflag, q1, med, q3, lo, hi
""")
def box_stats_by_flag(spark, sf):
    """5.30 box statistics: quartiles, fences, whiskers, outlier count."""
    b = P.box_stats(T(spark, sf, "lineitem"), ["l_extendedprice"], by="l_returnflag")
    # quartiles interpolate 2-decimal prices (<= 4 decimals), fences add one
    # more: 6 decimals never cut an exact value at a rounding midpoint
    return b.withColumns({c: r6(c) for c in ("q1", "median", "q3", "lower_fence", "upper_fence")})


@query("kde_discount", """
with s as (select count(l_discount) as n, stddev_samp(l_discount) as sd from lineitem),
h as (select n, sd * pow(n, -0.2) as h from s),
g as (select (0.01 * i)::double as x from range(0, 11) t(i)),
v as (select l_discount as v, count(*) as w from lineitem group by 1)
select round(x, 6) as x, round(sum(w * exp(-0.5 * pow((x - v) / h, 2))) / (n * h * sqrt(2 * pi())), 6) as density
from g cross join v cross join h group by x, n, h
""")
def kde_discount(spark, sf):
    """5.31 Gaussian KDE on a fixed grid (Scott's bandwidth)."""
    k = P.kde(T(spark, sf, "lineitem"), "l_discount", grid=[0.01 * i for i in range(11)])
    return k.select(r6("x").alias("x"), r6("density").alias("density"))


# ---------------------------------------------------------------- 12.x
@query("fill_constant", f"""
with g as ({_GAPS_SQL})
select l_orderkey, l_linenumber, coalesce(discount, 0.0) as discount, coalesce(flag, 'none') as flag from g
""")
def fill_constant(spark, sf):
    """12.1 fill constants per column."""
    g = _lineitem_with_gaps(spark, sf).select("l_orderkey", "l_linenumber", "discount", "flag")
    return M.fill(g, {"discount": 0.0, "flag": "none"})


@query("impute_median_mode", f"""
with g as ({_GAPS_SQL}),
m as (select quantile_cont(discount, 0.5) as md, quantile_cont(tax_sparse, 0.5) as mt from g),
fm as (select flag from g where flag is not null group by flag order by count(*) desc, flag limit 1)
select l_orderkey, l_linenumber, round(coalesce(discount, (select md from m)), 6) as discount,
  round(coalesce(tax_sparse, (select mt from m)), 6) as tax_sparse, coalesce(g.flag, (select flag from fm)) as flag
from g
""")
def impute_median_mode(spark, sf):
    """12.2 median fill (exact, interpolated) and 12.3 mode fill (ties ->
    smallest), fitted in one aggregate each."""
    g = _lineitem_with_gaps(spark, sf).select("l_orderkey", "l_linenumber", "discount", "tax_sparse", "flag")
    g = M.impute(g, ["discount", "tax_sparse"], "median")
    g = M.impute(g, ["flag"], "mode")
    return g.withColumns({"discount": r6("discount"), "tax_sparse": r6("tax_sparse")})


@query("sentinel_to_mode", """
with s as (select o_orderkey, case when o_orderstatus = 'P' then 'XNA' else o_orderstatus end as status from orders),
m as (select status from s group by 1 order by count(*) desc, status limit 1)
select o_orderkey, case when status = 'XNA' then (select status from m) else status end as status from s
""")
def sentinel_to_mode(spark, sf):
    """12.4 sentinel ('XNA') replaced by the mode (which counts the sentinel)."""
    o = T(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit("XNA")).otherwise(F.col("o_orderstatus")).alias("status"))
    return M.sentinel_to_mode(o, "status", "XNA")
