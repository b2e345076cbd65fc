"""Projection, schema and column-set operators (2.2).

Data-dependent projections (sparse / constant column drop) are two-phase:
one small aggregate action computes every column's statistic in a single
pass, then a generated ``select`` is built from the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def select(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def move_column(df: DataFrame, col: str, position: int) -> DataFrame:
    """Move ``col`` to index ``position`` (one generated select)."""
    rest = [c for c in df.columns if c != col]
    position = max(0, min(position, len(rest)))
    return df.select(*rest[:position], col, *rest[position:])


def cast(df: DataFrame, types: dict[str, str], safe: bool = True) -> DataFrame:
    """Cast columns; ``safe`` uses ``try_cast`` (bad value -> NULL, no error)."""
    return df.withColumns({c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t)) for c, t in types.items()})


def columns_of(df: DataFrame, kind: str = "numeric") -> list[str]:
    """Column names by type: 'numeric', 'other' (non-numeric), 'string',
    'bool', 'temporal'."""
    def is_(f, kinds):
        return isinstance(f.dataType, kinds)
    sel = {
        "numeric": lambda f: is_(f, NUMERIC),
        "other": lambda f: not is_(f, NUMERIC),
        "string": lambda f: is_(f, T.StringType),
        "bool": lambda f: is_(f, T.BooleanType),
        "temporal": lambda f: is_(f, (T.DateType, T.TimestampType, T.TimestampNTZType)),
    }[kind]
    return [f.name for f in df.schema.fields if sel(f)]


def columns_slice(df: DataFrame, start: int, stop: int | None = None) -> list[str]:
    return df.columns[start:stop]


def with_column(df: DataFrame, name: str, expr) -> DataFrame:
    return df.withColumn(name, expr if not isinstance(expr, str) else F.expr(expr))


def null_shares(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """Share of NULL (and NaN for floats) per column, one aggregate pass."""
    cols = cols or df.columns
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        miss = F.col(c).isNull() | F.isnan(c) if c in dbl else F.col(c).isNull()
        aggs.append(F.count_if(miss).alias(c))
    row = df.agg(*aggs).first()
    n = row["__n"]
    return {c: (row[c] / n if n else 0.0) for c in cols}


def drop_sparse(df: DataFrame, max_null_pct: float) -> DataFrame:
    """Drop columns whose NULL share is above ``max_null_pct`` percent
    (op 2.8; the reference drops share > threshold)."""
    shares = null_shares(df)
    keep = [c for c in df.columns if shares[c] * 100.0 <= max_null_pct]
    return df.select(*keep)


def constant_columns(df: DataFrame) -> list[str]:
    """All-NULL or single-valued columns (distinct count of non-nulls <= 1).

    Uses ``count(distinct)`` capped early: ``min(c) == max(c)`` is an exact,
    constant-memory test for "at most one distinct value" that avoids a
    distinct aggregation per column.
    """
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    aggs = []
    for f in fields:
        c = f.name
        aggs += [F.min(c).alias(f"{c}__mn"), F.max(c).alias(f"{c}__mx")]
    row = df.agg(*aggs).first()
    out = []
    for f in fields:
        mn, mx = row[f"{f.name}__mn"], row[f"{f.name}__mx"]
        if mn is None or mn == mx:
            out.append(f.name)
    return out


def drop_constant(df: DataFrame) -> DataFrame:
    """Drop all-NULL and single-valued columns (op 2.9)."""
    return df.drop(*constant_columns(df))


def collinear_pairs(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    """Pairs (a, b) with |Pearson r| >= ``threshold`` (op 2.10); long form
    from :func:`quarry.operators.profile.corr_long`."""
    from quarry.operators.profile import corr_long

    return corr_long(df, cols).filter(F.abs(F.col("r")) >= threshold)
