"""Sources and sinks: CSV with schema and decimal commas, staging,
ETL idempotency, sink append/replace."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources import etl, files, jdbc

from conftest import SF_SMALL


def test_decimal_comma_and_bad_values(spark):
    df = spark.createDataFrame([("1,5",), (" -2,25 ",), ("x",), (None,)], "s string")
    out = [r[0] for r in df.select(files.parse_decimal_comma("s")).collect()]
    assert out == [1.5, -2.25, None, None]


def test_csv_semicolon_roundtrip(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    path = scratch_path(spark, "t-csv")
    c.write.option("header", True).option("sep", ";").csv(path)
    back = files.read_csv(spark, path, c.schema, sep=";")
    assert back.exceptAll(c).count() == 0 and c.exceptAll(back).count() == 0


def test_etl_rerun_is_idempotent_and_batches_accumulate(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    st, tg, ag = (scratch_path(spark, n) for n in ("e-st", "e-tg", "e-ag"))
    n = c.count()
    r1 = etl.run_etl(spark, c, st, tg, ag, ts="2024-09-01 07:00:00").collect()
    r2 = etl.run_etl(spark, c, st, tg, ag, ts="2024-09-01 07:00:00").collect()
    assert [(x.extracted_at, x.user_count) for x in r1] == [(x.extracted_at, x.user_count) for x in r2] \
        == [(dt.datetime(2024, 9, 1, 7), n)]
    r3 = etl.run_etl(spark, c, st, tg, ag, ts="2024-09-02 07:00:00").collect()
    assert [x.extracted_at.day for x in r3] == [2, 1]  # newest first
    assert spark.read.parquet(tg).count() == 2 * n


def test_append_and_replace(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    t = scratch_path(spark, "sink")
    jdbc.append_to(o.limit(10), t)
    jdbc.append_to(o.limit(5), t)
    assert spark.read.parquet(t).count() == 15
    jdbc.replace_table(o.limit(3), t)
    assert spark.read.parquet(t).count() == 3


def test_stamp_is_one_literal(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    s = etl.stamp_batch(o)
    assert s.select(F.countDistinct("extracted_at")).first()[0] == 1


def test_jdbc_requires_bounds_for_partitioned_scan(spark):
    import pytest

    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:none://x", table="t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:none://x")


def test_csv_quotes_line_breaks_and_bad_rows(spark):
    import pytest

    from quarry.sources import files

    rows = [(1, 'he said "x, y"'), (2, "two\nlines"), (3, "back\\slash"), (4, "")]
    path = scratch_path(spark, "csv-odd")
    files.write_csv(spark.createDataFrame(rows, "a int, b string"), path)
    got = files.read_csv(spark, path, "a int, b string", multi_line=True).orderBy("a").collect()
    assert [(r.a, r.b or "") for r in got] == rows
    bad = scratch_path(spark, "csv-bad")
    spark.createDataFrame([("a,b",), ("1,x",), ("no,y",)], "value string").coalesce(1).write.text(bad)
    out = files.read_csv(spark, bad, "a int, b string", bad_rows="bad").cache()
    assert [r.bad for r in out.collect() if r.bad] == ["no,y"]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, bad, "a int, b string", mode="FAILFAST").collect()
