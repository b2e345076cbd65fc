"""Daily ETL as one Spark job (ops 1.10-1.12).

extract -> stamp -> stage (Parquet, partitioned by batch) -> load ->
aggregate -> publish. Reruns are idempotent: the stage and the target
are partitioned by the batch stamp and a rerun overwrites only its own
partition (dynamic partition overwrite), where the original's plain
append duplicated rows on retry.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "extracted_at"


def stamp_batch(df: DataFrame, ts: _dt.datetime | str | None = None, name: str = BATCH_COL) -> DataFrame:
    """One extraction time for the whole batch (op 1.10 / 10.9).

    A literal (not ``current_timestamp()`` per row) so every task and
    every retry stamps the same value.
    """
    return df.withColumn(name, F.lit(_resolve_ts(ts)).cast("timestamp_ntz"))


def _resolve_ts(ts) -> _dt.datetime:
    if ts is None:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    if isinstance(ts, str):
        return _dt.datetime.fromisoformat(ts)
    return ts


def run_etl(spark: SparkSession, source: DataFrame, stage_path: str, target_path: str,
            aggregate_path: str, ts: _dt.datetime | str | None = None,
            count_col: str | None = None) -> DataFrame:
    """Extract ``source`` -> stage -> load -> aggregate; returns the aggregate.

    ``aggregate``: ``SELECT extracted_at, COUNT(count_col) AS user_count
    GROUP BY extracted_at ORDER BY 1 DESC`` over everything loaded so far;
    without ``count_col`` rows are counted.
    """
    ts = _resolve_ts(ts)
    batch_id = ts.strftime("%Y%m%d%H%M%S")
    stamped = stamp_batch(source, ts).withColumn("batch_id", F.lit(batch_id))
    own = ("partitionOverwriteMode", "dynamic")  # a rerun replaces its own batch only
    # stage: write once, re-read, so the load never re-queries the source
    stamped.write.mode("overwrite").option(*own).partitionBy("batch_id").parquet(stage_path)
    staged = spark.read.parquet(stage_path).filter(F.col("batch_id") == batch_id)
    staged.write.mode("overwrite").option(*own).partitionBy("batch_id").parquet(target_path)
    loaded = spark.read.parquet(target_path).drop("batch_id")
    agg = (loaded.groupBy(BATCH_COL).agg(F.count(F.lit(1) if count_col is None else F.col(count_col)).alias("user_count"))
           .orderBy(F.col(BATCH_COL).desc_nulls_first()))
    agg.write.mode("overwrite").parquet(aggregate_path)
    return report_table(spark, aggregate_path)


def report_table(spark: SparkSession, path: str) -> DataFrame:
    """Read back the latest published aggregate (op 1.12)."""
    return spark.read.parquet(path)
