"""RDBMS source/sink (ops 1.6-1.9).

A JDBC scan is split into ``num_partitions`` range queries on a numeric
``partition_column`` so extraction runs on many executors instead of one
connection. Without a driver jar on the classpath these calls fail at
``load()``; tests exercise the same code path with the ``parquet``
format as stand-in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int = 64,
              properties: dict | None = None, fetch_size: int = 10000) -> DataFrame:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        # aggregate runs inside the database (op 1.7); the result is small
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partitioned JDBC scan needs lower_bound and upper_bound")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return r.load()


def _writer(df: DataFrame, target: str, fmt: str, url: str | None, properties: dict | None):
    if fmt == "jdbc":
        w = df.write.format("jdbc").option("url", url).option("dbtable", target)
        for k, v in (properties or {}).items():
            w = w.option(k, v)
        return w, None
    return df.write.format(fmt), target


def append_to(df: DataFrame, target: str, fmt: str = "parquet", url: str | None = None,
              properties: dict | None = None, partition_by: list[str] | None = None) -> None:
    """Incremental load (op 1.8). For file/table targets ``partition_by``
    lets a rerun overwrite just its own batch (see :func:`run_etl`)."""
    w, path = _writer(df, target, fmt, url, properties)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.mode("append").save(path) if path else w.mode("append").save()


def replace_table(df: DataFrame, target: str, fmt: str = "parquet", url: str | None = None,
                  properties: dict | None = None) -> None:
    """Publish a result, replacing the previous one (op 1.9)."""
    w, path = _writer(df, target, fmt, url, properties)
    w.mode("overwrite").save(path) if path else w.mode("overwrite").save()
