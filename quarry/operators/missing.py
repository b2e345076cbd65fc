"""Missing data (2.12): constant fill, fitted imputers, sentinel -> mode.

Imputers are fit with one aggregate pass over every requested column
(``median`` = exact interpolated median, T24; ``mode`` ties -> smallest,
T6) and then applied as a plain ``na.fill``/projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULLs with constants per column (op 12.1)."""
    return df.na.fill(values)


class Imputer:
    def __init__(self, values: dict):
        self.values = values

    def transform(self, df: DataFrame) -> DataFrame:
        vals = {c: v for c, v in self.values.items() if v is not None}
        if not vals:
            return df
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(dict(df.dtypes)[c])) for c, v in vals.items()})


_STRATS = {
    "median": lambda c: F.median(F.col(c)),
    "mean": lambda c: F.avg(F.col(c)),
    "mode": lambda c: F.mode(F.col(c), deterministic=True),
    "min": lambda c: F.min(F.col(c)),
    "max": lambda c: F.max(F.col(c)),
}


def fit_impute(df: DataFrame, cols: list[str] | None = None, strategy: str = "median") -> Imputer:
    """Learn one fill value per column in a single aggregate (ops 12.2/12.3);
    ``cols`` defaults to numeric columns for median/mean, all for mode."""
    if cols is None:
        from quarry.operators.schema import columns_of

        cols = columns_of(df, "numeric") if strategy in ("median", "mean") else df.columns
    if strategy == "median":
        from quarry.operators.profile import quantile_methods, quantiles

        how = quantile_methods(df, cols)
        big = [c for c in cols if how[c] in ("sort", "bracket")]
        small = [c for c in cols if c not in big]
        vals = {}
        if small:
            row = df.agg(*[_STRATS["median"](c).alias(c) for c in small]).first()
            vals.update({c: row[c] for c in small})
        for c in big:  # high-cardinality: exact median without a value->count map
            r = quantiles(df, c, [0.5], method=how[c]).first()
            vals[c] = r["value"] if r else None
        return Imputer(vals)
    row = df.agg(*[_STRATS[strategy](c).alias(c) for c in cols]).first()
    return Imputer({c: row[c] for c in cols})


def impute(df: DataFrame, cols: list[str] | None = None, strategy: str = "median") -> DataFrame:
    return fit_impute(df, cols, strategy).transform(df)


def sentinel_to_mode(df: DataFrame, col: str, sentinel) -> DataFrame:
    """Replace a sentinel (``'XNA'``) with the column mode (op 12.4). The
    mode is taken over all values *including* the sentinel, as in the
    original; it is a scalar subquery, so the plan stays one job."""
    mode = df.select(F.mode(F.col(col), deterministic=True)).scalar()
    return df.withColumn(col, F.when(F.col(col) == F.lit(sentinel), mode).otherwise(F.col(col)))
