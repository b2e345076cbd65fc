"""Source / sink analyses (2.1): write the test tables out in the
formats the reference reads and read them back with explicit schemas.
Scratch output goes under the session's ``spark.checkpoint.dir``."""

from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources import etl, files, jdbc
from quarry.plans.registry import T, query


@query("csv_roundtrip_customer", """
select * from customer
""")
def csv_roundtrip_customer(spark, sf):
    """1.1 / 1.4 header CSV written by executors, read back with the schema."""
    c = T(spark, sf, "customer")
    path = files.write_csv(c, scratch_path(spark, "csv"))
    return files.read_csv(spark, path, c.schema)


@query("csv_semicolon_decimal_comma", """
select c_custkey, c_name, c_acctbal from customer
""")
def csv_semicolon_decimal_comma(spark, sf):
    """1.2 ';'-separated CSV with 1.3 decimal-comma numbers ("1,5")."""
    c = T(spark, sf, "customer").select("c_custkey", "c_name",
                                        F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(",")).alias("c_acctbal"))
    path = scratch_path(spark, "csv-semi")
    c.write.option("header", True).option("sep", ";").csv(path)
    return files.read_csv(spark, path, "c_custkey long, c_name string, c_acctbal string", sep=";",
                          decimal_comma=["c_acctbal"])


@query("csv_with_row_id", """
select row_number() over (order by o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) - 1
  as row_id, * from orders
""")
def csv_with_row_id(spark, sf):
    """1.4 CSV sink with a consecutive row id (the pandas index)."""
    o = T(spark, sf, "orders")
    path = files.write_csv(o, scratch_path(spark, "csv-id"), with_row_id="row_id")
    return files.read_csv(spark, path, "row_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in o.schema))


@query("parquet_stage_roundtrip", """
select * from lineitem
""")
def parquet_stage_roundtrip(spark, sf):
    """1.5 Parquet staging (partitioned by return flag) and scan."""
    li = T(spark, sf, "lineitem")
    path = files.stage(li, scratch_path(spark, "stage"), partition_by=["l_returnflag"])
    return files.read_stage(spark, path).select(*li.columns)


@query("table_append_replace", """
select o_orderstatus, count(*) as n from orders group by 1
""")
def table_append_replace(spark, sf):
    """1.8 append (two batches) and 1.9 replace, through the sink API
    (Parquet stands in for a JDBC target; same writer code path)."""
    o = T(spark, sf, "orders")
    target = scratch_path(spark, "append")
    done = F.col("o_orderstatus").eqNullSafe("F")
    jdbc.append_to(o.filter(done), target)
    jdbc.append_to(o.filter(~done), target)
    agg = spark.read.parquet(target).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    pub = scratch_path(spark, "replace")
    jdbc.replace_table(agg.filter(F.lit(False)), pub)
    jdbc.replace_table(agg, pub)
    return spark.read.parquet(pub)


@query("etl_daily_users", """
select timestamp '2024-09-01 07:00:00' as extracted_at, count(c_name) as user_count from customer
""")
def etl_daily_users(spark, sf):
    """1.10-1.12 the daily ETL job: extract customers, stamp the batch,
    stage, load (partition overwrite: a rerun of the same batch replaces
    it instead of duplicating), aggregate, publish, read the report."""
    c = T(spark, sf, "customer")
    stage, target, agg = (scratch_path(spark, n) for n in ("etl-stage", "etl-target", "etl-agg"))
    etl.run_etl(spark, c, stage, target, agg, ts="2024-09-01 07:00:00", count_col="c_name")
    return etl.run_etl(spark, c, stage, target, agg, ts="2024-09-01 07:00:00", count_col="c_name")  # rerun: idempotent


@query("etl_two_batches", """
select * from (values (timestamp '2024-09-02 07:00:00'), (timestamp '2024-09-01 07:00:00')) t(extracted_at),
  (select count(c_name) as user_count from customer)
""")
def etl_two_batches(spark, sf):
    """1.11 two daily batches: one aggregate row per batch stamp, newest first."""
    c = T(spark, sf, "customer")
    stage, target, agg = (scratch_path(spark, n) for n in ("etl2-stage", "etl2-target", "etl2-agg"))
    etl.run_etl(spark, c, stage, target, agg, ts="2024-09-01 07:00:00", count_col="c_name")
    return etl.run_etl(spark, c, stage, target, agg, ts="2024-09-02 07:00:00", count_col="c_name")


@query("batch_stamp", """
select c_custkey, timestamp '2024-09-01 07:00:00' as extracted_at from customer
""")
def batch_stamp(spark, sf):
    """1.10 / 10.9 one extraction time per batch."""
    return etl.stamp_batch(T(spark, sf, "customer").select("c_custkey"), "2024-09-01 07:00:00")
