"""Streaming analyses (2.17): file streams over the test tables."""

from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.streaming import load_increment, run_window_totals
from quarry.plans.registry import T, query


@query("stream_daily_window_totals", """
select cast(time_bucket(interval 1 day, ts) as timestamp) as window_start,
  cast(time_bucket(interval 1 day, ts) + interval 1 day as timestamp) as window_end,
  event_type, round(sum(value), 2) as total, count(*) as n
from events group by all
""")
def stream_daily_window_totals(spark, sf):
    """17.1 daily tumbling-window totals per type from a file stream with a
    1-hour watermark; complete mode equals the batch answer."""
    schema = T(spark, sf, "events").schema
    out = run_window_totals(spark, f"{sf.rstrip('/')}/events*.parquet", schema, scratch_path(spark, "win-out"),
                            scratch_path(spark, "win-ckpt"), "ts", "1 day", "event_type", "value", "1 hour")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "event_type", F.round("total", 2).alias("total"), "n")


@query("stream_incremental_orders", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
""")
def stream_incremental_orders(spark, sf):
    """17.2 incremental load: orders staged in two batches, the later dates (and
    rows without a date) first; the first run loads batch 1, the second the
    older batch 2 only, a third run adds nothing."""
    o = T(spark, sf, "orders")
    stage = scratch_path(spark, "inc-stage")
    target = scratch_path(spark, "inc-target")
    ckpt = scratch_path(spark, "inc-ckpt")
    late = F.coalesce(F.col("o_orderdate") < "1998-01-01", F.lit(False))
    o.filter(~late).write.parquet(f"{stage}/b1")
    load_increment(spark, f"{stage}/*", o.schema, target, ckpt, key=["o_orderkey"])
    o.filter(late).write.parquet(f"{stage}/b2")
    load_increment(spark, f"{stage}/*", o.schema, target, ckpt, key=["o_orderkey"])
    load_increment(spark, f"{stage}/*", o.schema, target, ckpt, key=["o_orderkey"])
    return spark.read.schema(o.schema).parquet(target)
