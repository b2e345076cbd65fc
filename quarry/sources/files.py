"""File sources and sinks: CSV, Parquet staging, the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table. Parquet carries its own schema, so nothing is
    inferred; column pruning and filter pushdown reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Normalise NaN to NULL once, at read (Spark has both, pandas one)."""
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or df.columns) if c in dbl]
    if not cols:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in cols})


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             header: bool = True, decimal_comma: list[str] | None = None, mode: str = "PERMISSIVE",
             bad_rows: str | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV with an explicit schema (never inferSchema in a job).

    ``decimal_comma`` names string columns holding numbers like ``"1,5"``;
    they are converted to doubles (op 1.3). Quotes inside values are doubled. Values
    with line breaks need ``multi_line``, which reads each file in one task.
    ``mode='FAILFAST'`` stops at a row that does not
    fit the schema; ``bad_rows`` names a column that keeps the text of such rows.
    """
    r = (spark.read.option("header", header).option("sep", sep).option("escape", '"').option("multiLine", multi_line)
         .option("mode", mode))
    if bad_rows:
        fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
        schema = T.StructType([*fields, T.StructField(bad_rows, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", bad_rows)
    df = r.schema(schema).csv(path)
    if decimal_comma:
        df = df.withColumns({c: parse_decimal_comma(F.col(c)) for c in decimal_comma})
    return df


def parse_decimal_comma(col: Column | str) -> Column:
    """``"1,5"`` -> 1.5; unparsable -> NULL (no error under ANSI mode)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.trim(c.cast("string")), ",", ".").try_cast("double")


def write_csv(df: DataFrame, path: str, with_row_id: str | None = None, mode: str = "overwrite") -> str:
    """Write header CSV (part files, written in parallel by executors).

    ``with_row_id`` adds a stable, consecutive id column named so (the
    pandas index of the original), computed by :func:`quarry.operators.ranking.row_numbers`.
    """
    if with_row_id:
        from quarry.operators.ranking import row_numbers

        cols = df.columns
        df = row_numbers(df, order=cols, name=with_row_id, start=0).select(with_row_id, *cols)
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Stage a DataFrame as Parquet; returns the path (op 1.5)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
