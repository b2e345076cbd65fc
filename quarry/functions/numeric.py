"""Math and conditional scalars (2.11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else F.lit(col) if not isinstance(col, Column) else col


def abs_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """abs over a column list in one projection (op 11.1 / 16.5)."""
    return df.withColumns({c: F.abs(F.col(c)) for c in cols})


def floor_div(a, b) -> Column:
    """Python ``//``: floors toward -inf (Spark ``div`` truncates; T17)."""
    return F.floor(F.try_divide(_c(a), _c(b)))


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(_c(a), _c(b))


def pct(a, b, digits: int | None = 2) -> Column:
    v = F.try_divide(_c(a), _c(b)) * 100.0
    return F.round(v, digits) if digits is not None else v


_OPS = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
}


def compare(a, op: str, b) -> Column:
    return _OPS[op](_c(a), _c(b))


def flag(pred: Column, yes=1, no=0) -> Column:
    return F.when(pred, F.lit(yes)).otherwise(F.lit(no))


def label_target(col, bad: list) -> Column:
    """1 when the value is in ``bad``, else 0 (nulls -> 0)."""
    return F.when(_c(col).isin(list(bad)), F.lit(1)).otherwise(F.lit(0))
