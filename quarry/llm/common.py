"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

#: a word: a maximal run of characters outside space and 0x09-0x0D
WORD = r"[^\x20\x09-\x0D]+"
#: the characters that separate words
BLANK = r"[\x20\x09-\x0D]+"


class Scratch:
    """Tables written to a fresh folder under the shared checkpoint folder.

    ``keep`` cuts the lineage: the written files survive a lost executor
    and every later read gives the same rows. ``drop`` removes a table that
    no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/quarry-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # the frame that reads the table, for drop()
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            delete_path(self.spark, df._scratch_path)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_of(col: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """A row id that tells repeated rows apart. Write the result before use:
    ids are only fixed once materialised."""
    return df.withColumn(name, F.monotonically_increasing_id())


def running_totals(df: DataFrame, keys: list[str], order: str, values: dict[str, str], rows: int,
                   per_bucket: int = 50_000) -> DataFrame:
    """Exclusive running sums per key in a seeded order, without one task per key.

    ``order`` is a bigint column of hashes (ties broken by ``rid``). Rows fall into
    buckets of about ``per_bucket`` by the leading part of the hash; sums run inside (key,
    bucket) and are shifted by the totals of the earlier buckets of the
    key. ``values`` maps output names to summed columns.
    """
    from pyspark.sql import Window

    n = max(1, -(-rows // per_bucket))
    bucket = F.floor((F.col(order) / F.lit(2.0**64) + 0.5) * n).cast("int")
    d = df.withColumn("_b", F.greatest(F.lit(0), F.least(F.lit(n - 1), bucket)))
    inside = Window.partitionBy(*keys, "_b").orderBy(order, "rid").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    run = d.withColumns({o: F.coalesce(F.sum(v).over(inside), zero) for o, v in values.items()})
    if n == 1:
        return run.drop("_b")
    off = d.groupBy(*keys, "_b").agg(*[F.sum(v).alias(f"_s_{o}") for o, v in values.items()])
    off = off.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_k_b"),
                     *[F.coalesce(F.sum(f"_s_{o}").over(before), zero).alias(f"_o_{o}") for o in values])
    on = F.col("_b") == F.col("_k_b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    run = run.join(off, on)
    run = run.withColumns({o: F.col(o) + F.col(f"_o_{o}") for o in values})
    return run.drop("_b", "_k_b", *[f"_k_{k}" for k in keys], *[f"_o_{o}" for o in values])

