"""Streaming: complete mode equals batch, late rows beyond the watermark
are dropped in append mode, an incremental rerun adds nothing."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.streaming import load_increment, run_window_totals

from conftest import SF_SMALL


def test_complete_mode_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = run_window_totals(spark, f"{SF_SMALL}/events*.parquet", ev.schema, scratch_path(spark, "t-out"),
                            scratch_path(spark, "t-ck"), "ts", "1 day", "event_type", "value", "1 hour")
    batch = ev.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").start.alias("window_start"), "event_type").agg(
        F.sum("value").alias("total"))
    a = sorted((r.window_start, r.event_type, round(r.total, 6)) for r in out.collect())
    b = sorted((r.window_start, r.event_type, round(r.total, 6)) for r in batch.collect())
    assert a == b


def test_append_mode_drops_late_rows(spark):
    src = scratch_path(spark, "late-src")
    schema = "ts timestamp_ntz, k string, v double"
    base = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(base + dt.timedelta(hours=h), "a", 1.0) for h in range(0, 72, 6)], schema) \
        .coalesce(1).write.parquet(f"{src}/f1")
    spark.createDataFrame([(base + dt.timedelta(hours=70), "a", 1.0)], schema).coalesce(1).write.parquet(f"{src}/f2")
    # a row 3 days late arrives in a later file: its window is already
    # closed (Spark filters late rows by the watermark of two batches back)
    spark.createDataFrame([(base, "a", 100.0), (base + dt.timedelta(hours=80), "a", 1.0)], schema) \
        .coalesce(1).write.parquet(f"{src}/f3")
    out = run_window_totals(spark, f"{src}/*", schema, scratch_path(spark, "late-out"), scratch_path(spark, "late-ck"),
                            "ts", "1 day", "k", "v", "1 hour", mode="append", max_files_per_trigger=1)
    rows = {r.window_start.day: r.total for r in out.collect()}
    assert rows.get(1) == 4.0  # the late 100.0 was dropped


def test_incremental_rerun_adds_nothing(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    stage, target, ck = (scratch_path(spark, n) for n in ("inc-s", "inc-t", "inc-c"))
    o.write.parquet(f"{stage}/b1")
    n1 = load_increment(spark, f"{stage}/*", o.schema, target, ck, key=["o_orderkey"])
    n2 = load_increment(spark, f"{stage}/*", o.schema, target, ck, key=["o_orderkey"])
    assert n1 == n2 == o.count()


def test_incremental_load_keeps_late_rows_and_null_keys(spark):
    stage, target, ck = (scratch_path(spark, n) for n in ("l-s", "l-t", "l-c"))
    schema = "id bigint, t timestamp_ntz, v string"
    day = lambda d: dt.datetime(2024, 1, d)
    spark.createDataFrame([(1, day(10), "a"), (None, day(10), "n")], schema).coalesce(1).write.parquet(f"{stage}/b1")
    load_increment(spark, f"{stage}/*", schema, target, ck, key=["id"])
    spark.createDataFrame([(2, day(1), "late"), (3, None, "c"), (1, day(11), "again"), (None, day(10), "n"), (None, day(12), "m")],
                          schema).coalesce(1).write.parquet(f"{stage}/b2")
    assert load_increment(spark, f"{stage}/*", schema, target, ck, key=["id"]) == 5
    got = sorted((str(r.id), r.v) for r in spark.read.schema(schema).parquet(target).collect())
    assert got == [("1", "a"), ("2", "late"), ("3", "c"), ("None", "m"), ("None", "n")]
