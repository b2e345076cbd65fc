"""Feature engineering, splitting and resampling analyses (2.13).

Splits that an SQL oracle must reproduce use the portable md5 bucket;
the library default (xxhash64) is property-checked in tests.
"""

from pyspark.sql import functions as F

from quarry.operators import features as Fe
from quarry.operators import neighbors as Nb
from quarry.plans.registry import T, query

MD5_BUCKET_SQL = "(('0x' || substr(md5(cast({k} as varchar)), 1, 8))::ubigint % {n})"


def md5b(k, n=100):
    return MD5_BUCKET_SQL.format(k=k, n=n)


@query("label_encode_orders", """
select o_orderkey,
  (dense_rank() over (order by o_orderpriority) - 1)::integer as o_orderpriority_code,
  (dense_rank() over (order by o_orderstatus) - 1)::integer as o_orderstatus_code
from orders
""")
def label_encode_orders(spark, sf):
    """13.1 label encoding, alphabetical codes from 0 (T9)."""
    o = T(spark, sf, "orders")
    enc = Fe.fit_label_encoder(o, ["o_orderpriority", "o_orderstatus"])
    return enc.transform(o, "_code").select("o_orderkey", "o_orderpriority_code", "o_orderstatus_code")


@query("one_hot_segment", """
with c as (select c_custkey, case when c_nationkey = 0 then null else c_mktsegment end as seg from customer)
select c_custkey,
  case when seg = 'AUTOMOBILE' then 1 else 0 end as seg_AUTOMOBILE,
  case when seg = 'BUILDING' then 1 else 0 end as seg_BUILDING,
  case when seg = 'FURNITURE' then 1 else 0 end as seg_FURNITURE,
  case when seg = 'HOUSEHOLD' then 1 else 0 end as seg_HOUSEHOLD,
  case when seg = 'MACHINERY' then 1 else 0 end as seg_MACHINERY
from c
""")
def one_hot_segment(spark, sf):
    """13.2 one-hot with every level kept; NULL -> all zeros (T10)."""
    c = T(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") == 0, None).otherwise(F.col("c_mktsegment")).alias("seg"))
    return Fe.fit_one_hot(c, ["seg"]).transform(c)


@query("one_hot_ordered_levels", """
select o_orderkey,
  case when o_orderpriority = '1-URGENT' then 1 else 0 end as p_1_URGENT,
  case when o_orderpriority = '2-HIGH' then 1 else 0 end as p_2_HIGH,
  case when o_orderpriority = '3-MEDIUM' then 1 else 0 end as p_3_MEDIUM,
  0 as p_6_UNSEEN
from orders
""")
def one_hot_ordered_levels(spark, sf):
    """13.2 with a declared ordered level list: a level absent from the data
    still gets its (all-zero) column, values outside the list get zeros."""
    o = T(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("p"))
    enc = Fe.fit_one_hot(o, ["p"], levels={"p": ["1-URGENT", "2-HIGH", "3-MEDIUM", "6-UNSEEN"]})
    return enc.transform(o)


@query("one_hot_sparse_places", """
with p as (select nullif(p_brand, 'Brand#1') as b, p_name as m, p_partkey from part),
lb as (select b, row_number() over (order by b) - 1 as at from (select distinct b from p where b is not null)),
lm as (select m, row_number() over (order by m) - 1 + (select count(*) from lb) as at from (select distinct m from p where m is not null))
select p_partkey, lb.at as place from p join lb on p.b = lb.b
union all select p_partkey, lm.at from p join lm on p.m = lm.m
""")
def one_hot_sparse_places(spark, sf):
    """13.2 sparse one-hot of names with any number of levels: the places set per row."""
    p = T(spark, sf, "part").select("p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("b"), F.col("p_name").alias("m"))
    enc = Fe.fit_one_hot_sparse(p, ["b", "m"])
    return enc.indices(p).select("p_partkey", F.explode("indices").alias("place"))


@query("minmax_train_test", f"""
with s as (select c_custkey, c_acctbal, c_nationkey, 7.0 as k, {md5b('c_custkey')} < 80 as is_train from customer),
st as (select min(c_acctbal) as mn, max(c_acctbal) as mx, min(c_nationkey) as nmn, max(c_nationkey) as nmx from s where is_train)
select c_custkey, round((c_acctbal - mn) / (mx - mn), 6) as c_acctbal,
  round((c_nationkey - nmn) / (nmx - nmn), 6) as c_nationkey, 0.0::double as k
from s, st where not is_train
""")
def minmax_train_test(spark, sf):
    """13.5 min-max scaling fitted on train, applied to test; a constant
    column scales to 0 (T8). Split = portable md5 bucket (80/20)."""
    c = T(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit(7.0).alias("k"))
    train, test = Fe.split(c, "c_custkey", 0.8, method="md5")
    sc = Fe.fit_minmax(train, ["c_acctbal", "c_nationkey", "k"])
    out = sc.transform(test)
    return out.withColumns({"c_acctbal": F.round("c_acctbal", 6), "c_nationkey": F.round("c_nationkey", 6)})


@query("standardize_balance", """
with st as (select avg(c_acctbal) as mu, stddev_pop(c_acctbal) as sd, avg(c_nationkey) as nmu,
            stddev_pop(c_nationkey) as nsd from customer)
select c_custkey, round((c_acctbal - mu) / sd, 6) as c_acctbal, round((c_nationkey - nmu) / nsd, 6) as c_nationkey
from customer, st
""")
def standardize_balance(spark, sf):
    """13.6 standard scaling with the population std (T7)."""
    c = T(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    out = Fe.fit_standardize(c, ["c_acctbal", "c_nationkey"]).transform(c)
    return out.withColumns({"c_acctbal": F.round("c_acctbal", 6), "c_nationkey": F.round("c_nationkey", 6)})


@query("split_md5_sizes", f"""
select case when {md5b('o_orderkey')} < 80 then 'train' else 'test' end as part, count(*) as n,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders group by 1
""")
def split_md5_sizes(spark, sf):
    """13.12 seeded split (portable md5 variant): sizes and totals per side."""
    o = T(spark, sf, "orders")
    tr, te = Fe.split(o, "o_orderkey", 0.8, method="md5")

    def summ(d, name):
        return d.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"),
                     F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return summ(tr, "train").unionByName(summ(te, "test"))


@query("ordered_split_sizes", """
with r as (select *, row_number() over (order by o_orderdate, o_orderkey) - 1 as rn from orders)
select case when rn < floor(0.8 * (select count(*) from orders)) then 'train' else 'test' end as part, count(*) as n,
  cast(min(o_orderdate) as timestamp) as first_date, cast(max(o_orderdate) as timestamp) as last_date
from r group by 1
""")
def ordered_split_sizes(spark, sf):
    """13.13 temporal split: the first 80 % of orders by date train, the rest test."""
    o = T(spark, sf, "orders")
    n_train = int(0.8 * o.count())
    tr, te = Fe.ordered_split(o, ["o_orderdate", "o_orderkey"], n_train)

    def summ(d, name):
        return d.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"),
                     F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))
    return summ(tr, "train").unionByName(summ(te, "test"))


@query("fold_sizes_md5", f"""
select ({md5b('o_orderkey', 5)})::integer as fold, count(*) as n from orders group by 1
""")
def fold_sizes_md5(spark, sf):
    """13.16 K-fold assignment (portable md5 variant), rows per fold."""
    f = Fe.assign_folds(T(spark, sf, "orders"), "o_orderkey", k=5, method="md5")
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("repeated_fold_sizes", f"""
select repeat, ({md5b("(repeat::varchar || ':' || o_orderkey::varchar)", 5)})::integer as fold, count(*) as n
from orders, (select unnest(range(3))::integer as repeat) group by 1, 2
""")
def repeated_fold_sizes(spark, sf):
    """13.16 repeated K-fold (3 x 5, portable md5): rows per (repeat, fold)."""
    f = Fe.assign_folds(T(spark, sf, "orders"), "o_orderkey", k=5, repeats=3, method="md5")
    return f.groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("undersample_status", """
with c as (select o_orderstatus, count(*) as n from orders group by 1)
select o_orderstatus, (select min(n) from c) as n from c
""")
def undersample_status(spark, sf):
    """13.15 random undersampling: every class cut to the smallest class."""
    u = Fe.undersample(T(spark, sf, "orders"), "o_orderstatus", "o_orderkey", seed=3)
    return u.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("smote_quality", """
with c as (select l.quality, count(*) as n from labels l join documents d on l.doc_id = d.doc_id group by 1),
m as (select max(n) as mx, min(n) as mn, arg_min(quality, (n, quality)) as minority from c)
select quality, false as synthetic, n from c
union all
select minority, true, mx - mn from m where mx > mn
""")
def smote_quality(spark, sf):
    """13.14 SMOTE on document features (label = quality): class counts
    after oversampling (property-checked: balanced; synthetic rows lie
    between two minority rows)."""
    d = T(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                                         F.length("text").cast("double").alias("text_len"))
    lab = T(spark, sf, "labels").select("doc_id", "quality")
    df = d.join(lab, "doc_id")
    s = Nb.smote(df, "quality", ["n_chars", "text_len"], "doc_id", k=5, seed=1)
    return s.groupBy("quality", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("pca_customers", None)
def pca_customers(spark, sf):
    """13.7 two principal components of centred customer features."""
    c = T(spark, sf, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return Fe.pca(c, ["c_acctbal", "nation"], 2, keep=["c_custkey"])


@query("assembled_features", """
select l_orderkey, l_linenumber, l_extendedprice as label, l_quantity as f1, l_discount as f2, l_tax as f3 from lineitem
""")
def assembled_features(spark, sf):
    """13.10 X/y assembly (vector column, exposed as an array)."""
    from pyspark.ml.functions import vector_to_array

    li = T(spark, sf, "lineitem")
    a = Fe.assemble(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", keep=["l_orderkey", "l_linenumber"])
    x = vector_to_array("features")
    return a.select("l_orderkey", "l_linenumber", F.col(a.columns[-1]).alias("label"), *[x[i].alias(f"f{i + 1}") for i in range(3)])
