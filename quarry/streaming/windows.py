"""Tumbling-window totals per category with a watermark (op 17.1).

Parquet gives TIMESTAMP_NTZ and ``withWatermark`` needs TIMESTAMP, so the
event time is cast first (the session time zone is UTC, so no shift).
State is kept per (window, key) and dropped once the watermark passes
the window end; the state store lives under the checkpoint location, so
a restarted query (or a lost executor) resumes from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_totals(stream: DataFrame, ts: str, width: str, key: str, value: str, delay: str) -> DataFrame:
    """``(window_start, window_end, key, total, n)`` per tumbling window."""
    s = stream.withColumn("__et", F.col(ts).cast("timestamp"))
    return (s.withWatermark("__et", delay)
            .groupBy(F.window("__et", width).alias("w"), F.col(key))
            .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "total", "n"))


def run_window_totals(spark: SparkSession, source_glob: str, schema: T.StructType | str, out_path: str,
                      checkpoint: str, ts: str, width: str, key: str, value: str, delay: str,
                      mode: str = "complete", max_files_per_trigger: int | None = None) -> DataFrame:
    """Drive :func:`window_totals` over a file source to completion
    (``availableNow``) and return what the sink holds.

    ``complete``: every micro-batch rewrites the full result table to
    ``out_path`` (``foreachBatch`` + overwrite, idempotent per batch id).
    ``append``: finalized windows only (those behind the watermark) are
    appended to a Parquet sink with exactly-once file commits.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_glob)
    agg = window_totals(src, ts, width, key, value, delay)
    if mode == "complete":
        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out_path)

        q = (agg.writeStream.outputMode("complete").foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    else:
        q = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
